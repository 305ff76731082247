"""Source schemas and warehouse column specifications."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# --- source schemas (fixed values: names, order and types of the input files)

SALES_CSV = T.StructType(
    [
        T.StructField("transaction_id", T.StringType()),
        T.StructField("customer_code", T.StringType()),
        T.StructField("product_code", T.StringType()),
        T.StructField("sale_date", T.StringType()),
        T.StructField("quantity", T.IntegerType()),
        T.StructField("unit_price", T.DoubleType()),
        T.StructField("discount", T.DoubleType()),
        T.StructField("payment_method", T.StringType()),
    ]
)

#: Columns that wide sales files have besides.
WIDE_SALES_CSV = T.StructType(
    [
        *SALES_CSV.fields,
        T.StructField("currency", T.StringType()),
        T.StructField("sales_channel", T.StringType()),
        T.StructField("region", T.StringType()),
    ]
)

PRODUCTS_CSV = T.StructType(
    [
        T.StructField("product_code", T.StringType()),
        T.StructField("product_name", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("subcategory", T.StringType()),
        T.StructField("brand", T.StringType()),
        T.StructField("unit_price", T.DoubleType()),
        T.StructField("cost_price", T.DoubleType()),
        T.StructField("weight_kg", T.DoubleType()),
    ]
)

SUPPLIERS_CSV = T.StructType(
    [
        T.StructField("supplier_id", T.StringType()),
        T.StructField("company_name", T.StringType()),
        T.StructField("contact_person", T.StringType()),
        T.StructField("email", T.StringType()),
        T.StructField("phone", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("rating", T.DoubleType()),
        T.StructField("contract_start", T.DateType()),
        T.StructField("payment_terms", T.StringType()),
    ]
)

CUSTOMERS_JSON = T.StructType(
    [
        T.StructField("customer_id", T.StringType()),
        T.StructField(
            "personal_info",
            T.StructType(
                [
                    T.StructField("first_name", T.StringType()),
                    T.StructField("last_name", T.StringType()),
                    T.StructField("full_name", T.StringType()),
                    T.StructField("birth_date", T.StringType()),
                ]
            ),
        ),
        T.StructField(
            "contact",
            T.StructType(
                [
                    T.StructField("email", T.StringType()),
                    T.StructField("phone", T.StringType()),
                    T.StructField("secondary_phone", T.StringType()),
                ]
            ),
        ),
        T.StructField(
            "address",
            T.StructType(
                [
                    T.StructField("country", T.StringType()),
                    T.StructField("city", T.StringType()),
                    T.StructField("district", T.StringType()),
                    T.StructField("postal_code", T.StringType()),
                ]
            ),
        ),
        T.StructField("registration_date", T.StringType()),
        T.StructField("segment", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField(
            "preferences",
            T.StructType(
                [
                    T.StructField("marketing_emails", T.BooleanType()),
                    T.StructField("language", T.StringType()),
                    T.StructField("currency", T.StringType()),
                ]
            ),
        ),
        T.StructField(
            "metadata",
            T.StructType(
                [
                    T.StructField("acquisition_channel", T.StringType()),
                    T.StructField("lifetime_value", T.DoubleType()),
                    T.StructField("last_activity", T.StringType()),
                ]
            ),
        ),
    ]
)

# --- working types

#: Prices and discounts as read, held exactly.
PRICE = T.DecimalType(16, 2)
#: Computed line amounts: three decimals, since the tax is a tenth of cents, and
#: room for any price times any quantity; their sums fit 38 digits.
AMOUNT = T.DecimalType(27, 3)


# --- warehouse tables


@dataclass(frozen=True)
class ColumnSpec:
    """One warehouse column: its type and the constraints on it."""

    name: str
    type: T.DataType
    required: bool = False
    length: int | None = None
    default: object = None


#: Default that stands for the run's time.
RUN_TIME = "run_time"

_STRING, _DATE, _LONG, _INT = T.StringType(), T.DateType(), T.LongType(), T.IntegerType()
_TIME = T.TimestampNTZType()


def _text(name: str, length: int, **rest) -> ColumnSpec:
    return ColumnSpec(name, _STRING, length=length, **rest)


def _number(name: str, precision: int, scale: int, **rest) -> ColumnSpec:
    return ColumnSpec(name, T.DecimalType(precision, scale), **rest)


# The warehouse's column names, widths, precisions and defaults.

DIM_CUSTOMERS = (
    ColumnSpec("customer_id", _LONG, required=True),
    _text("customer_code", 50, required=True),
    _text("first_name", 100),
    _text("last_name", 100),
    _text("email", 255),
    _text("phone", 20),
    _text("country", 100),
    _text("city", 100),
    ColumnSpec("registration_date", _DATE),
    _text("customer_segment", 50),
    ColumnSpec("created_at", _TIME, default=RUN_TIME),
    ColumnSpec("updated_at", _TIME, default=RUN_TIME),
)

DIM_PRODUCTS = (
    ColumnSpec("product_id", _LONG, required=True),
    _text("product_code", 50, required=True),
    _text("product_name", 255),
    _text("category", 100),
    _text("subcategory", 100),
    _text("brand", 100),
    _number("unit_price", 10, 2),
    _number("cost_price", 10, 2),
    _number("weight_kg", 8, 3),
    ColumnSpec("created_at", _TIME, default=RUN_TIME),
    ColumnSpec("updated_at", _TIME, default=RUN_TIME),
)

FACT_SALES = (
    ColumnSpec("sale_id", _LONG, required=True),
    _text("transaction_id", 100, required=True),
    ColumnSpec("customer_id", _LONG),
    ColumnSpec("product_id", _LONG),
    ColumnSpec("sale_date", _DATE, required=True),
    ColumnSpec("sale_timestamp", _TIME, required=True),
    ColumnSpec("quantity", _INT, required=True),
    _number("unit_price", 10, 2, required=True),
    _number("discount_amount", 10, 2, default=0),
    _number("tax_amount", 10, 2, default=0),
    _number("total_amount", 12, 2, required=True),
    _text("payment_method", 50),
    _text("currency_code", 3, default="USD"),
    ColumnSpec("created_at", _TIME, default=RUN_TIME),
)

DAILY_SALES_SUMMARY = (
    ColumnSpec("summary_date", _DATE, required=True),
    _number("total_sales_amount", 15, 2),
    ColumnSpec("total_transactions", _LONG),
    ColumnSpec("unique_customers", _LONG),
    _number("avg_transaction_value", 10, 2),
    _text("top_product_category", 100),
    ColumnSpec("created_at", _TIME, default=RUN_TIME),
)

DATA_QUALITY_LOGS = (
    ColumnSpec("log_id", _LONG, required=True),
    _text("pipeline_run_id", 100),
    _text("table_name", 100),
    _text("check_name", 100),
    _text("check_result", 20),
    ColumnSpec("check_details", _STRING),
    ColumnSpec("records_processed", _LONG),
    ColumnSpec("records_failed", _LONG),
    ColumnSpec("execution_time", _TIME, default=RUN_TIME),
)

WAREHOUSE = {
    "dim_customers": DIM_CUSTOMERS,
    "dim_products": DIM_PRODUCTS,
    "fact_sales": FACT_SALES,
    "daily_sales_summary": DAILY_SALES_SUMMARY,
    "data_quality_logs": DATA_QUALITY_LOGS,
}


def table_schema(name: str) -> T.StructType:
    """A warehouse table's columns as a Spark schema."""
    return T.StructType([T.StructField(s.name, s.type) for s in WAREHOUSE[name]])
