"""Validity rules and standardisation for sales, customers and products.

The rules of a table are a mapping from the name of a defect to the condition
a good row meets. The same mapping filters the rows and counts the rejects.
Prices are judged as they are stored, and one that cannot be stored is a defect
of its own.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from saleswright.functions import dates, money, text
from saleswright.operators.dedup import one_per_key

Rules = Mapping[str, Column]


def sales_rules(formats: Sequence[str] = (dates.ISO_DATE,)) -> Rules:
    return {
        "missing_transaction_id": F.col("transaction_id").isNotNull(),
        "missing_customer_code": F.col("customer_code").isNotNull(),
        "missing_product_code": F.col("product_code").isNotNull(),
        "bad_quantity": F.col("quantity") > 0,
        "unstorable_unit_price": ~money.unstorable(F.col("unit_price")),
        "bad_unit_price": money.price(F.col("unit_price")) > 0,
        "unstorable_discount": ~money.unstorable(F.col("discount")),
        "bad_sale_date": dates.parse_date(F.col("sale_date"), formats).isNotNull(),
    }


def valid_sales(
    formats: Sequence[str] = (dates.ISO_DATE,), doubles: Collection[str] = ()
) -> Column:
    """Whether a row meets all of :func:`sales_rules`, with every input named once.

    The optimizer writes the expression behind a column out at each mention, and
    a filter that grows beyond what the JVM compiles is interpreted. A price
    above zero can be stored, so that needs no condition of its own. Columns
    among ``doubles`` are judged by bounds instead of being made decimals.
    """
    unit_price, discount = F.col("unit_price"), F.col("discount")
    return (
        F.col("transaction_id").isNotNull()
        & F.col("customer_code").isNotNull()
        & F.col("product_code").isNotNull()
        & (F.col("quantity") > 0)
        & (
            money.positive_double(unit_price)
            if "unit_price" in doubles
            else money.price(unit_price) > 0
        )
        & (
            money.storable_double(discount)
            if "discount" in doubles
            else money.storable(discount)
        )
        & dates.parse_date(F.col("sale_date"), formats).isNotNull()
    )


def customer_rules() -> Rules:
    return {
        "missing_customer_code": F.col("customer_code").isNotNull(),
        "missing_first_name": F.col("first_name").isNotNull(),
        "missing_last_name": F.col("last_name").isNotNull(),
    }


def product_rules() -> Rules:
    return {
        "missing_product_code": F.col("product_code").isNotNull(),
        "missing_product_name": F.col("product_name").isNotNull(),
        "unstorable_unit_price": ~money.unstorable(F.col("unit_price")),
        "bad_unit_price": money.price(F.col("unit_price")) > 0,
        "unstorable_cost_price": ~money.unstorable(F.col("cost_price")),
        "bad_cost_price": money.price(F.col("cost_price")) > 0,
        "cost_above_price": money.price(F.col("cost_price"))
        <= money.price(F.col("unit_price")),
        "bad_weight": F.col("weight_kg") > 0,
    }


def valid_products() -> Column:
    """Whether a row meets all of :func:`product_rules`; a cost above zero bounds the price."""
    cost = money.price(F.col("cost_price"))
    return (
        F.col("product_code").isNotNull()
        & F.col("product_name").isNotNull()
        & (cost > 0)
        & (cost <= money.price(F.col("unit_price")))
        & (F.col("weight_kg") > 0)
    )


def keep_valid(df: DataFrame, rules: Rules) -> DataFrame:
    """Rows that meet every rule; an unknown outcome counts as a failure."""
    return df.where(reduce(lambda a, b: a & b, rules.values()))


def first_defect(rules: Rules) -> Column:
    """Name of the first rule a row breaks, NULL for a valid row."""
    broken = [
        F.when(~F.coalesce(good, F.lit(False)), F.lit(name)) for name, good in rules.items()
    ]
    return F.coalesce(*broken)


# A valid copy always wins over an invalid one, so the filters below may come
# first and the shuffles carry valid rows only.


def clean_sales(
    df: DataFrame,
    formats: Sequence[str] = (dates.ISO_DATE,),
    currency: Column | None = None,
) -> DataFrame:
    """Valid sales, one per transaction, with parsed date and computed amounts.

    ``formats`` may name further date forms to recover. ``currency`` replaces
    the fixed currency, for instance with the source's own column.
    """
    unit_price, quantity, discount = F.col("unit_price"), F.col("quantity"), F.col("discount")
    doubles = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)]
    rows = one_per_key(df.where(valid_sales(formats, doubles)), ["transaction_id"])
    return rows.withColumns(
        {
            "sale_date": dates.parse_date(F.col("sale_date"), formats),
            "unit_price": money.price(unit_price),
            "discount": money.price(discount),
            "payment_method": text.code_text(F.col("payment_method")),
            "sale_timestamp": dates.midnight(dates.parse_date(F.col("sale_date"), formats)),
            "discount_amount": money.or_zero(discount),
            "tax_amount": money.tax(unit_price, quantity),
            "total_amount": money.total(unit_price, quantity, discount),
            "currency_code": F.lit("USD") if currency is None else currency,
        }
    )


def clean_customers(df: DataFrame) -> DataFrame:
    """Valid customers, one per code, with standard text, email, phone and date."""
    rows = one_per_key(keep_valid(df, customer_rules()), ["customer_code"])
    titled = ("first_name", "last_name", "country", "city")
    return rows.withColumns(
        {
            **{name: text.title_text(F.col(name)) for name in titled},
            "email": text.valid_email(F.col("email")),
            "phone": text.phone_digits(F.col("phone")),
            "registration_date": dates.parse_date(F.col("registration_date")),
            "customer_segment": text.code_text(F.col("customer_segment")),
        }
    )


def clean_products(df: DataFrame) -> DataFrame:
    """Valid products, one per code, with standard text and exact prices."""
    rows = one_per_key(df.where(valid_products()), ["product_code"])
    titled = ("product_name", "category", "subcategory", "brand")
    return rows.withColumns(
        {
            **{name: text.title_text(F.col(name)) for name in titled},
            "unit_price": money.price(F.col("unit_price")),
            "cost_price": money.price(F.col("cost_price")),
        }
    )


def count_rejects(df: DataFrame, key: str, rules: Rules) -> DataFrame:
    """How many rows cleaning keeps and drops: ``(outcome, records)``.

    Every row has one outcome: ``kept``, ``duplicate`` or the first rule it
    breaks. Invalid rows collapse to one group per rule within each task, and
    copies of a key to one row, before anything is shuffled.
    """
    judged = df.select(first_defect(rules).alias("defect"), F.col(key).alias("key"))
    per_key = judged.groupBy(
        "defect", F.when(F.col("defect").isNull(), F.col("key")).alias("key")
    ).agg(F.count(F.lit(1)).alias("n"))

    valid = F.col("defect").isNull()
    counts = {
        "kept": F.count_if(valid),
        "duplicate": F.coalesce(F.sum(F.when(valid, F.col("n") - 1)), F.lit(0)),
        **{
            name: F.coalesce(F.sum(F.when(F.col("defect") == name, F.col("n"))), F.lit(0))
            for name in rules
        },
    }
    tally = per_key.agg(*[count.alias(name) for name, count in counts.items()])
    pairs = [
        F.struct(F.lit(name).alias("outcome"), F.col(name).alias("records")) for name in counts
    ]
    return tally.select(F.inline(F.array(*pairs)))


def count_rejected_emails(df: DataFrame) -> DataFrame:
    """Addresses given and addresses that do not have the valid form."""
    given = F.col("email").isNotNull()
    bad = given & text.valid_email(F.col("email")).isNull()
    return df.agg(F.count_if(given).alias("emails"), F.count_if(bad).alias("email_rejected"))
