"""File sinks. Each returns the number of rows written, counted while writing."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, DataFrameWriter, Observation
from pyspark.sql import functions as F

from saleswright.session import SHUFFLES_GO, temporary_conf
from saleswright.storage import drop, swap_in


def _counted(df: DataFrame, save) -> int:
    seen = Observation()
    with temporary_conf(df.sparkSession, SHUFFLES_GO):
        save(df.observe(seen, F.count(F.lit(1)).alias("n")))
    try:
        return seen.get["n"]
    except (KeyError, Py4JJavaError):
        # The optimizer drops the count along with a plan it finds to be empty.
        if df.isEmpty():
            return 0
        raise


def _parquet(df: DataFrame, mode: str) -> DataFrameWriter:
    return df.write.mode(mode).option("compression", "snappy")


def write_table(df: DataFrame, path: str) -> int:
    """Replace a Parquet table."""
    return _counted(df, lambda rows: _parquet(rows, "overwrite").parquet(path))


def append_table(df: DataFrame, path: str) -> int:
    """Add rows to a Parquet table."""
    return _counted(df, lambda rows: _parquet(rows, "append").parquet(path))


#: Rows, about, that are written at a time where the rows go through several shuffles
#: before they are written. The files of these shuffles lie on disk together.
PART_ROWS = 1 << 24


def parts_for(rows: int) -> int:
    """In how many parts so many rows should be written."""
    return max(1, -(-rows // PART_ROWS))


def in_parts(df: DataFrame, by: str, parts: int) -> Iterator[DataFrame]:
    """The rows in parts, all rows of a value of ``by`` in the same one."""
    if parts == 1:
        yield df
        return
    for k in range(parts):
        yield df.where(F.pmod(F.xxhash64(by), F.lit(parts)) == k)


# Writing many small partitions costs time per file, not per byte, so shuffle
# partitions are merged only while tiny; large ones are not affected.
_MANY_FILES = {"spark.sql.adaptive.coalescePartitions.minPartitionSize": "4k"}


def _partitioned(
    df: DataFrame,
    path: str,
    by: str,
    mode: str,
    finish: Callable[[DataFrame], DataFrame] | None = None,
    **options: str,
) -> int:
    """Write one folder per value of ``by``.

    The rebalance brings a value's rows together, so that a small one makes one
    file, and lets AQE cut a large one into several tasks and files.
    """

    def save(rows: DataFrame) -> None:
        _parquet(rows, mode).options(**options).partitionBy(by).parquet(path)

    rows = df.hint("rebalance", F.col(by))
    with temporary_conf(df.sparkSession, _MANY_FILES):
        # Above the rebalance, so that only tasks whose files stay are counted.
        return _counted(rows if finish is None else finish(rows), save)


def write_partitioned(df: DataFrame, path: str, by: str, parts: int = 1) -> int:
    """Replace a Parquet table kept in one folder per value of ``by``.

    With more ``parts`` than one, the rows of so many values are computed and
    written at a time, beside the table's place, and put there when all are.
    """
    if parts == 1:
        return _partitioned(df, path, by, "overwrite", partitionOverwriteMode="static")
    fresh = f"{path.rstrip('/')}.{uuid.uuid4().hex}"
    drop(df.sparkSession, path)
    try:
        n = sum(_partitioned(part, fresh, by, "append") for part in in_parts(df, by, parts))
    except Exception:
        drop(df.sparkSession, fresh)
        raise
    swap_in(df.sparkSession, fresh, path)
    return n


def append_partitioned(
    df: DataFrame, path: str, by: str, finish: Callable[[DataFrame], DataFrame] | None = None
) -> int:
    """Add rows to a partitioned Parquet table.

    ``finish`` is applied in the tasks that write, after the last shuffle.
    """
    return _partitioned(df, path, by, "append", finish)


def replace_partitions(df: DataFrame, path: str, by: str) -> int:
    """Replace only those partitions that ``df`` has rows for.

    ``df`` may be read from ``path`` itself: new files are staged and swapped
    in when the job ends.
    """
    return _partitioned(df, path, by, "overwrite", partitionOverwriteMode="dynamic")


def replace_table(df: DataFrame, path: str) -> int:
    """Replace a table by rows that were computed from it.

    The rows are written beside the table, which is then exchanged for them. A
    write that fails leaves the table as it was.
    """
    fresh = f"{path.rstrip('/')}.{uuid.uuid4().hex}"
    try:
        n = write_table(df, fresh)
    except Exception:
        drop(df.sparkSession, fresh)
        raise
    swap_in(df.sparkSession, fresh, path)
    return n


def write_csv(df: DataFrame, path: str, compression: str = "none") -> int:
    """CSV part files with a header each, padding kept; empty texts read back as NULL.

    A compressed part file is read by one task, whatever its size.
    """
    return _counted(
        df,
        lambda rows: rows.write.mode("overwrite")
        .option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("compression", compression)
        .csv(path),
    )


def write_json(df: DataFrame, path: str) -> int:
    """JSON lines, NULL fields included."""
    return _counted(
        df,
        lambda rows: rows.write.mode("overwrite").option("ignoreNullFields", False).json(path),
    )
