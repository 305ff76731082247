"""Dimensions, the sales fact and row-level enrichment."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saleswright.functions import dates, money
from saleswright.operators.ingest import add_default_columns
from saleswright.operators.joins import join_on_text
from saleswright.schemas import FACT_SALES, RUN_TIME, ColumnSpec


def _dimension(df: DataFrame, attributes: Iterable[str], run_ts: Column) -> DataFrame:
    return df.select(*attributes, run_ts.alias("created_at"), run_ts.alias("updated_at"))


# The attributes of the two dimensions.
CUSTOMER_ATTRIBUTES = (
    "customer_code",
    "first_name",
    "last_name",
    "email",
    "phone",
    "country",
    "city",
    "registration_date",
    "customer_segment",
)
PRODUCT_ATTRIBUTES = (
    "product_code",
    "product_name",
    "category",
    "subcategory",
    "brand",
    "unit_price",
    "cost_price",
    "weight_kg",
)


def customer_dimension(customers: DataFrame, run_ts: Column) -> DataFrame:
    return _dimension(customers, CUSTOMER_ATTRIBUTES, run_ts)


def product_dimension(products: DataFrame, run_ts: Column) -> DataFrame:
    return _dimension(products, PRODUCT_ATTRIBUTES, run_ts)


def sales_fact(
    sales: DataFrame, customers: DataFrame, products: DataFrame, run_ts: Column
) -> DataFrame:
    """Clean sales that have both dimensions, enriched, with margin and size.

    Only the needed dimension columns enter the joins. Spark broadcasts a
    dimension whose measured size allows it; otherwise the sort-merge join
    splits the partitions of hot customers and products at run time.
    """
    buyer = customers.select("customer_code", "customer_segment")
    item = products.select(
        "product_code",
        F.col("category").alias("product_category"),
        F.col("brand").alias("product_brand"),
        "cost_price",
    )
    return (
        join_on_text(join_on_text(sales, buyer, "customer_code"), item, "product_code")
        .select(
            "transaction_id",
            "customer_code",
            "product_code",
            "sale_date",
            "sale_timestamp",
            "quantity",
            "unit_price",
            "discount_amount",
            "tax_amount",
            "total_amount",
            "payment_method",
            "currency_code",
            "customer_segment",
            "product_category",
            "product_brand",
            run_ts.alias("created_at"),
            money.margin(F.col("unit_price"), F.col("cost_price")).alias("profit_margin"),
            money.order_size(F.col("total_amount")).alias("order_size_category"),
        )
    )


def fact_join_loss(sales: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """Rows the fact's inner joins drop, and why, in one row."""
    # Copies of a (customer, product) pair count as one row in the joins, so a
    # hot pair costs no more than a rare one.
    pairs = sales.groupBy("customer_code", "product_code").agg(F.count(F.lit(1)).alias("n"))
    buyer = customers.select("customer_code", F.lit(True).alias("has_customer"))
    item = products.select("product_code", F.lit(True).alias("has_product"))
    matched = pairs.join(buyer, "customer_code", "left").join(item, "product_code", "left")

    no_buyer, no_item = F.col("has_customer").isNull(), F.col("has_product").isNull()

    def rows_where(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0))

    return matched.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows_in"),
        rows_where(~no_buyer & ~no_item).alias("rows_out"),
        rows_where(no_buyer).alias("missing_customer"),
        rows_where(no_item).alias("missing_product"),
    )


def warehouse_fact(fact: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """The fact with surrogate ids in place of codes, in the warehouse's types."""
    buyer = customers.select("customer_id", "customer_code")
    item = products.select("product_id", "product_code")
    keyed = join_on_text(join_on_text(fact, buyer, "customer_code"), item, "product_code")
    columns = [spec for spec in FACT_SALES if spec.name != "sale_id"]
    return keyed.select([F.col(s.name).try_cast(s.type).alias(s.name) for s in columns])


def to_table_types(df: DataFrame, specs: Iterable[ColumnSpec]) -> DataFrame:
    """Columns of ``specs`` that ``df`` has, cast; what does not fit becomes NULL."""
    present = [s for s in specs if s.name in df.columns]
    return df.select([F.col(s.name).try_cast(s.type).alias(s.name) for s in present])


def with_table_defaults(
    df: DataFrame, specs: Iterable[ColumnSpec], run_ts: Column
) -> DataFrame:
    """Fill omitted columns with the defaults the table declares."""
    defaults = {
        s.name: (run_ts if s.default == RUN_TIME else F.lit(s.default)).cast(s.type)
        for s in specs
        if s.default is not None
    }
    return add_default_columns(df, defaults)


def _has(df: DataFrame, *names: str) -> bool:
    return set(names) <= set(df.columns)


def with_gross_total(df: DataFrame) -> DataFrame:
    """``total_amount`` = price times quantity, where both columns exist."""
    if not _has(df, "unit_price", "quantity"):
        return df
    return df.withColumn("total_amount", money.gross(F.col("unit_price"), F.col("quantity")))


def with_rate_total(df: DataFrame) -> DataFrame:
    """``total_amount`` with the discount as a fraction; gross where there is none."""
    if not _has(df, "unit_price", "quantity", "discount"):
        return with_gross_total(df)
    amount = money.total_after_rate(F.col("unit_price"), F.col("quantity"), F.col("discount"))
    return df.withColumn("total_amount", amount)


def with_sale_year(df: DataFrame) -> DataFrame:
    """``sale_year``, NULL for an unreadable date, where there is a sale date."""
    if not _has(df, "sale_date"):
        return df
    return df.withColumn("sale_year", F.year(dates.parse_date(F.col("sale_date"))))


def enrich_with_products(sales: DataFrame, products: DataFrame, run_ts: Column) -> DataFrame:
    """Every sale with its product's category and brand, NULL where unknown."""
    stamped = sales.withColumn("processing_timestamp", run_ts)
    if not (_has(sales, "product_code") and _has(products, "product_code")):
        return stamped
    labels = products.select("product_code", "category", "brand")
    return join_on_text(stamped, labels, "product_code", "left")
