"""Data-quality checks, their log rows, tallies, gate and alert level.

A check row is ``(table_name, check_name, check_result, check_details,
records_processed, records_failed)``. The counts of a table come from one
aggregate over it; references are checked on distinct keys.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# The results a check may have and the wording of its details.
PASS, FAIL, WARNING, ERROR = "PASS", "FAIL", "WARNING", "ERROR"

ENOUGH_ROWS = "Table has {n} records (>= {least})"
TOO_FEW_ROWS = "Table has only {n} records (< {least})"
NO_DUPLICATES = "No duplicates found in {columns}"
DUPLICATES = "Found {n} duplicate records in {columns}"
CUSTOMERS_OK = "All customer references are valid"
CUSTOMERS_BAD = "Found {n} orphan customer references"
PRODUCTS_OK = "All product references are valid"
PRODUCTS_BAD = "Found {n} orphan product references"
QUANTITY_OK = "All sales have valid quantities"
QUANTITY_BAD = "Found {n} sales with invalid quantities"
PRICE_OK = "All prices are positive"
PRICE_BAD = "Found {n} records with negative prices"
DATE_OK = "No future sales dates found"
DATE_BAD = "Found {n} sales with future dates"

#: Checks whose failure stops the run.
CRITICAL_CHECKS = (
    "completeness",
    "uniqueness",
    "customer_integrity",
    "product_integrity",
    "not_null",
    "primary_key",
)

CHECK_SCHEMA = (
    "table_name string, check_name string, check_result string, check_details string, "
    "records_processed long, records_failed long"
)


def _wording(template: str, n: Column) -> Column:
    if "{n}" not in template:
        return F.lit(template)
    before, _, after = template.partition("{n}")
    return F.concat(F.lit(before), n.cast("string"), F.lit(after))


def _check(
    table: str,
    name: str,
    failed: Column,
    good: str,
    bad: str,
    processed: Column | None = None,
    on_failure: str = FAIL,
    shown: Column | None = None,
    ok: Column | None = None,
) -> Column:
    """A check row as a struct over one row of counts."""
    ok = (failed == 0) if ok is None else ok
    shown = failed if shown is None else shown
    return F.struct(
        F.lit(table).alias("table_name"),
        F.lit(name).alias("check_name"),
        F.when(ok, F.lit(PASS)).otherwise(F.lit(on_failure)).alias("check_result"),
        F.when(ok, _wording(good, shown)).otherwise(_wording(bad, shown)).alias("check_details"),
        (F.lit(0) if processed is None else processed).cast("long").alias("records_processed"),
        failed.cast("long").alias("records_failed"),
    )


def _rows(counts: DataFrame, checks: Iterable[Column]) -> DataFrame:
    return counts.select(F.inline(F.array(*checks)))


# --- completeness and uniqueness


def _completeness(table: str, least: int) -> Column:
    n = F.col("n")
    return _check(
        table,
        "completeness",
        failed=F.lit(0),
        good=ENOUGH_ROWS.replace("{least}", str(least)),
        bad=TOO_FEW_ROWS.replace("{least}", str(least)),
        processed=n,
        shown=n,
        ok=n >= least,
    )


def _uniqueness(table: str, columns: Sequence[str]) -> Column:
    names = ", ".join(columns)
    return _check(
        table,
        "uniqueness",
        failed=F.col("n") - F.col("n_distinct"),
        good=NO_DUPLICATES.replace("{columns}", names),
        bad=DUPLICATES.replace("{columns}", names),
        processed=F.col("n"),
    )


def _distinct(columns: Sequence[str]) -> Column:
    """Distinct keys; a key with a NULL part is not one, so it counts as repeated."""
    return F.count_distinct(*[F.col(c) for c in columns]).alias("n_distinct")


def check_completeness(df: DataFrame, table: str, least: int = 1) -> DataFrame:
    return _rows(df.agg(F.count(F.lit(1)).alias("n")), [_completeness(table, least)])


def check_uniqueness(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    counts = df.agg(F.count(F.lit(1)).alias("n"), _distinct(columns))
    return _rows(counts, [_uniqueness(table, columns)])


# --- references


#: Bytes of a dimension's ids, as bits, up to which they are broadcast: 500 million ids.
BITMAP_BYTES = 64 * 1024**2
#: Bits of a bitmap of Spark's (fixed value).
_BITMAP_BITS = 32768


def _id_bits(parent: DataFrame, key: str) -> DataFrame | None:
    """The ids of a dimension as bitmaps per bucket, if they are few and dense enough.

    What they take follows from the largest id, which is looked up first.
    """
    if parent.schema[key].dataType.typeName() not in ("integer", "long"):
        return None
    least, largest = parent.agg(F.min(key), F.max(key)).first()
    if least is None or least < 1 or (largest // _BITMAP_BITS + 1) * _BITMAP_BITS // 8 > BITMAP_BYTES:
        return None
    return parent.groupBy(F.bitmap_bucket_number(F.col(key)).alias(f"_bucket_{key}")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(F.col(key))).alias(f"_bits_{key}")
    )


def _with_bits(rows: DataFrame, bits: DataFrame, key: str) -> DataFrame:
    """Rows beside the bitmap that their key would be in."""
    here = F.bitmap_bucket_number(F.col(key)) == F.col(f"_bucket_{key}")
    return rows.join(F.broadcast(bits), here, "left")


def _orphans(key: str) -> Column:
    """Rows whose key's bit is not set; without a bitmap, or a key, none is."""
    place = F.bitmap_bit_position(F.col(key))
    byte = F.substring(F.col(f"_bits_{key}"), (F.floor(place / 8) + 1).cast("int"), F.lit(1))
    value = F.conv(F.hex(byte), 16, 10).cast("int")
    known = F.getbit(value, (place % 8).cast("int")) == 1
    return F.count_if(~F.coalesce(known, F.lit(False)))


def count_orphans(rows: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Rows whose key the parent lacks, as one row ``(n)``; NULL keys count.

    Rows are counted per key before the anti join, so a hot key joins once.
    """
    per_key = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    lost = per_key.join(parent.select(key), key, "left_anti")
    return lost.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))


def check_references(
    fact: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    table: str = "fact_sales",
    keys: tuple[str, str] = ("customer_id", "product_id"),
) -> DataFrame:
    """References to both dimensions; ``keys`` name the customer and product key.

    Dense integer ids of up to ``BITMAP_BYTES`` are broadcast as bits, and then
    one scan of the fact, of which nothing is shuffled, answers for both
    dimensions. Codes and larger ids are counted per key and joined.
    """
    n = F.col("n")
    customer_bits = _id_bits(customers, keys[0])
    product_bits = _id_bits(products, keys[1]) if customer_bits is not None else None
    if customer_bits is not None and product_bits is not None:
        probed = _with_bits(_with_bits(fact.select(*keys), customer_bits, keys[0]), product_bits, keys[1])
        counts = probed.agg(_orphans(keys[0]).alias("buyers"), _orphans(keys[1]).alias("items"))
        return _rows(
            counts,
            [
                _check(table, "customer_integrity", F.col("buyers"), CUSTOMERS_OK, CUSTOMERS_BAD),
                _check(table, "product_integrity", F.col("items"), PRODUCTS_OK, PRODUCTS_BAD),
            ],
        )
    buyers = count_orphans(fact, customers, keys[0])
    items = count_orphans(fact, products, keys[1])
    return _rows(
        buyers, [_check(table, "customer_integrity", n, CUSTOMERS_OK, CUSTOMERS_BAD)]
    ).unionByName(_rows(items, [_check(table, "product_integrity", n, PRODUCTS_OK, PRODUCTS_BAD)]))


# --- business rules


def _rule_counts(as_of: Column) -> list[Column]:
    negative = (F.col("unit_price") < 0) | (F.col("total_amount") < 0)
    return [
        F.count_if(F.col("quantity") <= 0).alias("bad_quantity"),
        F.count_if(negative).alias("bad_price"),
        F.count_if(F.col("sale_date") > as_of).alias("bad_date"),
    ]


def _rule_checks(table: str) -> list[Column]:
    quantity, price, day = F.col("bad_quantity"), F.col("bad_price"), F.col("bad_date")
    return [
        _check(table, "quantity_validation", quantity, QUANTITY_OK, QUANTITY_BAD),
        _check(table, "price_validation", price, PRICE_OK, PRICE_BAD),
        _check(table, "date_validation", day, DATE_OK, DATE_BAD, on_failure=WARNING),
    ]


def check_business_rules(
    fact: DataFrame, as_of: Column, table: str = "fact_sales"
) -> DataFrame:
    return _rows(fact.agg(*_rule_counts(as_of)), _rule_checks(table))


# --- the whole suite


@dataclass(frozen=True)
class TableCheck:
    """What the suite asks of a table."""

    key: tuple[str, ...]
    least: int = 1


SUITE: Mapping[str, TableCheck] = {
    "dim_customers": TableCheck(("customer_code",)),
    "dim_products": TableCheck(("product_code",)),
    "fact_sales": TableCheck(("transaction_id",)),
}


def _or_error(
    spark: SparkSession, table: str, checks: Sequence[str], build: Callable[[], DataFrame]
) -> DataFrame:
    """The checks, or one ERROR row each where they cannot even be planned.

    A missing table or column shows at planning time; a failure while running
    is an infrastructure failure and ends the job instead.
    """
    try:
        rows = build()
        rows.schema  # noqa: B018 - resolves the plan
        return rows
    except (AnalysisException, KeyError) as problem:
        reason = str(problem).splitlines()[0]
        return spark.createDataFrame(
            [(table, check, ERROR, reason, 0, 0) for check in checks], CHECK_SCHEMA
        )


def run_all_checks(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    as_of: Column,
    keys: tuple[str, str] = ("customer_id", "product_id"),
) -> DataFrame:
    """All eleven checks over the two dimensions and the fact.

    The fact's counts, uniqueness and rules come from one aggregate over it.
    """

    def table_checks(name: str) -> DataFrame:
        want = SUITE[name]
        counts = [F.count(F.lit(1)).alias("n"), _distinct(want.key)]
        checks = [_completeness(name, want.least), _uniqueness(name, want.key)]
        if name == "fact_sales":
            counts += _rule_counts(as_of)
            checks += _rule_checks(name)
        return _rows(tables[name].agg(*counts), checks)

    def references() -> DataFrame:
        return check_references(
            tables["fact_sales"], tables["dim_customers"], tables["dim_products"], keys=keys
        )

    base = ["completeness", "uniqueness"]
    rules = ["quantity_validation", "price_validation", "date_validation"]
    parts = [
        _or_error(
            spark,
            name,
            base + (rules if name == "fact_sales" else []),
            lambda name=name: table_checks(name),
        )
        for name in SUITE
    ]
    parts.append(
        _or_error(spark, "fact_sales", ["customer_integrity", "product_integrity"], references)
    )
    return reduce(DataFrame.unionByName, parts)


# --- log, tally, gate and alert


def log_rows(checks: DataFrame, run_id: str, run_ts: Column, after: int = 0) -> DataFrame:
    """Check rows as the quality log holds them, numbered from ``after`` on.

    A run has a few dozen checks, so they are numbered in one task.
    """
    order = Window.orderBy("table_name", "check_name", "check_details")
    return checks.select(
        (F.row_number().over(order) + F.lit(after)).cast("long").alias("log_id"),
        F.lit(run_id).alias("pipeline_run_id"),
        "table_name",
        "check_name",
        "check_result",
        "check_details",
        "records_processed",
        "records_failed",
        run_ts.alias("execution_time"),
    )


def summarize_checks(log: DataFrame) -> DataFrame:
    """Tallies per run.

    A check that could not run is counted apart and is critical, as its
    outcome is unknown.
    """
    result = F.col("check_result")
    critical = (result == FAIL) & F.col("check_name").isin(*CRITICAL_CHECKS)
    return log.groupBy("pipeline_run_id").agg(
        F.count(F.lit(1)).alias("total_checks"),
        F.count_if(result == PASS).alias("passed_checks"),
        F.count_if(result == FAIL).alias("failed_checks"),
        F.count_if(result == WARNING).alias("warning_checks"),
        F.count_if(result == ERROR).alias("error_checks"),
        F.count_if(critical | (result == ERROR)).alias("critical_failures"),
    )


def add_alert_level(summary: DataFrame) -> DataFrame:
    """CRITICAL, WARNING or NONE for each run's tallies."""
    level = (
        F.when(F.col("critical_failures") > 0, "CRITICAL")
        .when(F.col("warning_checks") > 0, "WARNING")
        .otherwise("NONE")
    )
    return summary.withColumn("alert_level", level)


class QualityGateError(RuntimeError):
    """Raised when a run has critical failures."""


def enforce_gate(summary: DataFrame) -> None:
    """Stop the caller when any run in ``summary`` has critical failures."""
    found = summary.agg(F.sum("critical_failures").alias("n")).first()["n"]
    if found:
        raise QualityGateError(f"{found} critical data-quality failures")
