"""Removing repeated rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def one_per_key(
    df: DataFrame, keys: Sequence[str], prefer: Column | None = None
) -> DataFrame:
    """One row per key; NULL keys form one group.

    The survivor is the first row by ``prefer`` (true before false) and then
    by all other columns, so the result does not depend on row order. Spark
    keeps the best row per key within each task before the shuffle, so a key
    with very many copies sends one row per task.
    """
    rest = [F.col(f"`{c}`").asc_nulls_first() for c in df.columns if c not in set(keys)]
    if prefer is not None:
        rest.insert(0, F.coalesce(prefer, F.lit(False)).desc())
    if not rest:
        return df.dropDuplicates(list(keys))
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*rest))
    return df.withColumn("_place", place).where(F.col("_place") == 1).drop("_place")


def complete_distinct(df: DataFrame) -> DataFrame:
    """Distinct rows without any NULL."""
    return df.na.drop("any").distinct()
