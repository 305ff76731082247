"""Profiles of data sets and counts of known defects."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from saleswright.functions import dates, text

# States of a data set, the extreme price, the standard phone
# form and the three non-standard date forms.
OK, UNREADABLE, NOT_FOUND = "OK", "ERROR", "NOT_FOUND"
EXTREME_PRICE = 999999.99
STANDARD_PHONE = r"^\+51-999-[0-9]{6}$"
DATE_SHAPES = {
    "date_dd_mm_yyyy": r"^[0-9]{2}/[0-9]{2}/[0-9]{4}$",
    "date_mm_dd_yyyy": r"^[0-9]{2}-[0-9]{2}-[0-9]{4}$",
    "date_yyyymmdd": r"^[0-9]{8}$",
}

_PROFILE = "dataset string, records long, columns int, null_values long, duplicates long, status string"


def _name(column: str) -> Column:
    return F.col(f"`{column}`")


def null_counts(df: DataFrame, dataset: str) -> DataFrame:
    """NULLs per column, from one pass."""
    counts = df.agg(*[F.count_if(_name(c).isNull()).alias(c) for c in df.columns])
    rows = [
        F.struct(
            F.lit(dataset).alias("dataset"),
            F.lit(c).alias("column_name"),
            _name(c).alias("null_values"),
        )
        for c in df.columns
    ]
    return counts.select(F.inline(F.array(*rows)))


def _per_row(df: DataFrame) -> DataFrame:
    """Distinct rows with their number of copies; copies merge before the shuffle."""
    nulls = reduce(lambda a, b: a + b, [_name(c).isNull().cast("long") for c in df.columns])
    return df.groupBy(*[_name(c) for c in df.columns]).agg(
        F.count(F.lit(1)).alias("_copies"), F.sum(nulls).alias("_nulls")
    )


def duplicate_count(df: DataFrame, dataset: str) -> DataFrame:
    """Rows, and rows that repeat an earlier one in every column."""
    return _per_row(df).agg(
        F.lit(dataset).alias("dataset"),
        F.coalesce(F.sum("_copies"), F.lit(0)).alias("records"),
        F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("duplicates"),
    )


def profile(df: DataFrame, dataset: str) -> DataFrame:
    """Records, columns, NULL cells, repeated rows and status, in one row."""
    return _per_row(df).agg(
        F.lit(dataset).alias("dataset"),
        F.coalesce(F.sum("_copies"), F.lit(0)).alias("records"),
        F.lit(len(df.columns)).alias("columns"),
        F.coalesce(F.sum("_nulls"), F.lit(0)).alias("null_values"),
        F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("duplicates"),
        F.lit(OK).alias("status"),
    )


def profile_sources(spark: SparkSession, sources: Mapping[str, object]) -> DataFrame:
    """A profile row per data set.

    ``sources`` maps a name to a function that opens the data set. One that is
    not there is reported as NOT_FOUND, one that cannot be opened as ERROR.
    """

    def row(dataset: str, open_source) -> DataFrame:
        try:
            return profile(open_source(), dataset)
        except AnalysisException as problem:
            missing = problem.getCondition() == "PATH_NOT_FOUND"
            status = NOT_FOUND if missing else UNREADABLE
            return spark.createDataFrame([(dataset, 0, None, None, None, status)], _PROFILE)

    return reduce(DataFrame.unionByName, [row(*item) for item in sources.items()])


def stage_counts(stages: Mapping[str, Mapping[str, DataFrame]]) -> DataFrame:
    """Tables and records per stage."""
    counts = [
        df.agg(F.lit(stage).alias("stage"), F.count(F.lit(1)).alias("n"))
        for stage, tables in stages.items()
        for df in tables.values()
    ]
    return (
        reduce(DataFrame.unionByName, counts)
        .groupBy("stage")
        .agg(F.count(F.lit(1)).alias("tables"), F.sum("n").alias("records"))
    )


# --- defects


def _defects(df: DataFrame, table: str, counts: Mapping[str, Column]) -> DataFrame:
    tally = df.agg(
        F.count(F.lit(1)).alias("_all"), *[c.alias(name) for name, c in counts.items()]
    )
    share = {
        name: F.coalesce(
            F.try_divide(_name(name).cast("double") * 100, F.col("_all").cast("double")), F.lit(0.0)
        )
        for name in counts
    }
    rows = [
        F.struct(
            F.lit(table).alias("table_name"),
            F.lit(name).alias("defect"),
            _name(name).alias("n"),
            share[name].alias("pct"),
        )
        for name in counts
    ]
    return tally.select(F.inline(F.array(*rows)))


def _repeats(column: str) -> Column:
    return F.count(column) - F.count_distinct(column)


def sales_defects(df: DataFrame) -> DataFrame:
    day, price, method = F.col("sale_date"), F.col("unit_price"), F.col("payment_method")
    unreadable = day.isNotNull() & dates.parse_date(
        day, (dates.ISO_DATE, *dates.OTHER_DATES)
    ).isNull()
    return _defects(
        df,
        "sales",
        {
            "repeated_transaction_id": _repeats("transaction_id"),
            "missing_discount": F.count_if(F.col("discount").isNull()),
            "missing_payment_method": F.count_if(method.isNull() | (F.trim(method) == "")),
            **{name: F.count_if(day.rlike(shape)) for name, shape in DATE_SHAPES.items()},
            "date_unreadable": F.count_if(unreadable),
            "price_zero": F.count_if(price == 0),
            "price_negative": F.count_if(price < 0),
            "price_extreme": F.count_if(price >= EXTREME_PRICE),
        },
    )


def customer_defects(df: DataFrame) -> DataFrame:
    first, last, email = F.col("first_name"), F.col("last_name"), F.col("email")
    has_case = F.lower(first) != F.upper(first)
    any_foreign = reduce(
        lambda a, b: a | b,
        [F.coalesce(text.has_non_ascii(c), F.lit(False)) for c in (first, last, email)],
    )
    return _defects(
        df,
        "customers",
        {
            "name_lower": F.count_if(has_case & (first == F.lower(first))),
            "name_upper": F.count_if(has_case & (first == F.upper(first))),
            "name_padded": F.count_if(first != F.trim(first)),
            "repeated_email": _repeats("email"),
            "phone_not_standard": F.count_if(~F.col("phone").rlike(STANDARD_PHONE)),
            "non_ascii": F.count_if(any_foreign),
            "missing_email": F.count_if(email.isNull()),
            "missing_phone": F.count_if(F.col("phone").isNull()),
        },
    )


def product_defects(df: DataFrame) -> DataFrame:
    price, cost = F.col("unit_price"), F.col("cost_price")
    return _defects(
        df,
        "products",
        {
            "cost_above_price": F.count_if(cost > price),
            "price_zero": F.count_if(price == 0),
            "missing_cost": F.count_if(cost.isNull()),
        },
    )
