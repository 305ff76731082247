"""Helpers that several text operators share."""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import saleswright

#: A group is hot if it holds more than one part in this many of all rows, so
#: there are never more hot groups than this and they may be broadcast.
HOT_PARTS = 1000
#: Rows of a narrow table that may be broadcast after they were counted.
BROADCAST_ROWS = 500_000


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package, wherever they run."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        root = os.path.dirname(os.path.dirname(os.path.abspath(saleswright.__file__)))
        to = os.path.join(tempfile.mkdtemp(prefix="saleswright-code-"), "saleswright")
        spark.sparkContext.addPyFile(shutil.make_archive(to, "zip", root, "saleswright"))
        _shipped.add(app)


_kept: dict[object, object] = {}


def kept(key: object, make: Callable[[], object]):
    """An object that a worker builds once and uses for all its tasks.

    Workers outlive a stage, so only the object asked for last is held.
    """
    if key not in _kept:
        _kept.clear()
        _kept[key] = make()
    return _kept[key]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; only Spark opens its files."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_bytes(column: str | Column = "text") -> Column:
    """A text as UTF-8 bytes; null counts as empty."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit("")).cast("binary")


def parts_of(batch: pa.RecordBatch, column: str, most: int) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about ``most`` bytes of ``column``, a row at least each."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy()
    part = (np.cumsum(sizes, dtype=np.int64) - sizes) // most
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield batch.slice(a, b - a)


def laid_out(flat: np.ndarray, lengths: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of runs of ``lengths`` in ``flat``, those at ``which``, one after the other, and where each ends."""
    starts = np.cumsum(lengths) - lengths
    taken = lengths[which]
    ends = np.cumsum(taken)
    at = np.repeat(starts[which] - (ends - taken), taken)
    at += np.arange(len(at))
    return flat[at], ends


def joined_ids(coded: Sequence[bytes], which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The 32-bit numbers of ``coded`` at ``which``, one after the other, and where each ends."""
    lengths = np.fromiter(map(len, coded), np.int64, len(coded)) >> 2
    return laid_out(np.frombuffer(b"".join(coded), "<u4"), lengths, which)


def listed(values: pa.Array) -> list:
    """Python values of a column, made all at once."""
    return values.to_numpy(zero_copy_only=False).tolist()


def crc_rest(id_col: str, parts: int) -> Column:
    """crc32 of the id as text modulo ``parts``; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % parts


def carried(rows: DataFrame, *own: Column | str) -> DataFrame:
    """The columns in ``_row`` and an operator's ``own``.

    A carried column with the name of one of ``own`` gives way to it.
    """
    named = rows.select(*own).columns
    taken = {name.lower() for name in named}
    names = [f.name for f in rows.schema["_row"].dataType if f.name.lower() not in taken]
    return rows.select(*[F.col("_row").getField(c).alias(c) for c in names], *own)


def attach(
    rows: DataFrame, groups: DataFrame, keys: Sequence[str], size: str, total: int
) -> DataFrame:
    """Left join of rows to one-row-per-key ``groups`` that no hot key can stall.

    ``size`` counts the rows a group has among ``total`` rows. The at most
    ``HOT_PARTS`` groups above ``total / HOT_PARTS`` are broadcast; their rows,
    and rows without a key, are dealt over all partitions of the shuffled join
    that answers the rest. Columns of ``groups`` other than the keys are added.
    ``rows`` should be read from files: then a repeated task deals its rows the
    same way again.
    """
    keys = list(keys)
    payload = [c for c in groups.columns if c not in keys]
    bar = total / HOT_PARTS
    hot = groups.filter(F.col(size) > bar).select(
        *keys, *[F.col(c).alias(f"_hot_{c}") for c in payload], F.lit(True).alias("_hot")
    )
    cold = groups.filter(F.col(size) <= bar).withColumn("_spread", F.lit(0))
    no_key = F.lit(False)
    for key in keys:
        no_key = no_key | F.col(key).isNull()
    spread = F.when(
        F.col("_hot").isNotNull() | no_key, 1 + F.floor(F.rand(11) * (1 << 20)).cast("int")
    ).otherwise(0)
    joined = (
        rows.join(F.broadcast(hot), keys, "left")
        .withColumn("_spread", spread)
        .join(cold, [*keys, "_spread"], "left")
    )
    kept = [F.col(c) for c in rows.columns]
    added = [
        F.when(F.col("_hot").isNotNull(), F.col(f"_hot_{c}")).otherwise(F.col(c)).alias(c)
        for c in payload
    ]
    return joined.select(*kept, *added)
