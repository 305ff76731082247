"""Checks of the constraints the warehouse tables declare."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from saleswright.schemas import ColumnSpec

# Names of the checks over whole tables.
NOT_NULL, TEXT_LENGTH, DECIMAL_RANGE = "not_null", "text_length", "decimal_range"
PRIMARY_KEY = "primary_key"

_RESULT = "table_name string, column_name string, violations long"


def _broken(df: DataFrame, spec: ColumnSpec, kind: str) -> Column | None:
    """When a row breaks a constraint of a column; None where there is none to break."""
    present, value = spec.name in df.columns, F.col(spec.name)
    if kind == NOT_NULL and spec.required:
        # Every row lacks a column that is absent.
        return value.isNull() if present else F.lit(True)
    if kind == TEXT_LENGTH and present and spec.length is not None:
        return F.char_length(value) > spec.length
    if kind == DECIMAL_RANGE and present and isinstance(spec.type, T.DecimalType):
        return value.isNotNull() & value.try_cast(spec.type).isNull()
    return None


def count_violations(
    df: DataFrame,
    table: str,
    specs: Iterable[ColumnSpec],
    kinds: Sequence[str],
    key: str | None = None,
) -> DataFrame:
    """Rows that break each constraint of some kinds, from one pass over the table.

    Gives ``check_name``, ``table_name``, ``column_name`` and ``violations``. With
    ``key`` the rows whose key is repeated or missing are counted as
    ``primary_key`` in the same pass.
    """
    found = [(k, s.name, _broken(df, s, k)) for k in kinds for s in specs]
    wanted = {(k, name): F.count_if(bad) for k, name, bad in found if bad is not None}
    if key is not None:
        wanted[PRIMARY_KEY, key] = F.count(F.lit(1)) - F.count_distinct(F.col(key))
    if not wanted:
        return df.sparkSession.createDataFrame([], f"check_name string, {_RESULT}")
    counts = df.agg(*[count.alias(f"c{i}") for i, count in enumerate(wanted.values())])
    rows = [
        F.struct(
            F.lit(kind).alias("check_name"),
            F.lit(table).alias("table_name"),
            F.lit(name).alias("column_name"),
            F.col(f"c{i}").alias("violations"),
        )
        for i, (kind, name) in enumerate(wanted)
    ]
    return counts.select(F.inline(F.array(*rows)))


def _of_kind(df: DataFrame, table: str, specs: Iterable[ColumnSpec], kind: str) -> DataFrame:
    return count_violations(df, table, list(specs), [kind]).drop("check_name")


def missing_values(df: DataFrame, table: str, specs: Iterable[ColumnSpec]) -> DataFrame:
    """NULLs per required column; every row lacks a column that is absent."""
    return _of_kind(df, table, specs, NOT_NULL)


def overlong_texts(df: DataFrame, table: str, specs: Iterable[ColumnSpec]) -> DataFrame:
    """Texts longer than the column allows, per column."""
    return _of_kind(df, table, specs, TEXT_LENGTH)


def overflowing_decimals(df: DataFrame, table: str, specs: Iterable[ColumnSpec]) -> DataFrame:
    """Numbers that do not fit the column's precision, per column."""
    return _of_kind(df, table, specs, DECIMAL_RANGE)


def as_checks(violations: DataFrame) -> DataFrame:
    """Check rows, one per table and kind, from counts per column."""
    bad, check = F.col("n") > 0, F.col("check_name")
    found = F.concat(F.lit("Found "), F.col("n").cast("string"), F.lit(" violations of "), check)
    return (
        violations.groupBy("table_name", "check_name")
        .agg(F.sum("violations").alias("n"))
        .select(
            "table_name",
            "check_name",
            F.when(bad, "FAIL").otherwise("PASS").alias("check_result"),
            F.when(bad, found)
            .otherwise(F.concat(F.lit("No violations of "), check))
            .alias("check_details"),
            F.lit(0).cast("long").alias("records_processed"),
            F.col("n").alias("records_failed"),
        )
    )
