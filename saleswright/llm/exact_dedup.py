"""Exact duplicates found by refining groups step by step."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from saleswright.llm.common import BROADCAST_ROWS, attach, carried, table
from saleswright.storage import materialize

#: Characters that the prefix hash covers.
PREFIX_CHARS = 64

ORACLE_SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1
         AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


def _keys(text: Column) -> list[Column]:
    return [
        F.octet_length(text).cast("long").alias("_len"),
        F.xxhash64(F.substring(text, 1, PREFIX_CHARS)).alias("_pre"),
    ]


def exact_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: Sequence[str] = ()
) -> DataFrame:
    """Every row with the group of rows that have the same text.

    Texts are the same when identical byte for byte; null counts as empty. The
    row with the largest id stays, of equal ids any one; a null id is below all
    others. Groups are refined by length, then by a hash of the prefix, then by
    SHA-256 of the whole text, and each step looks only at rows the steps before
    left in groups of two or more. Counts are combined before they are shuffled;
    of the surviving rows only the hash travels. Surviving (length, prefix) keys
    are broadcast if there are at most ``BROADCAST_ROWS``; beyond that every row
    is hashed in its scan, because moving texts would cost more than hashing.

    Returns ``carry`` columns (default: the id) plus ``keep_id``,
    ``group_size`` and ``kept``; columns of ``docs`` that are not carried are
    not read. No rows give no rows.
    """
    carry = list(carry or [id_col])
    text = F.coalesce(F.col(text_col), F.lit(""))
    lengths = materialize(
        docs.groupBy(F.octet_length(text).cast("long").alias("_len"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .filter("_n > 1")
        .select("_len"),
        "lengths",
    )
    few = lengths.count() <= BROADCAST_ROWS
    alive = materialize(
        docs.select(*_keys(text))
        .join(F.broadcast(lengths) if few else lengths, "_len", "left_semi")
        .groupBy("_len", "_pre")
        .agg(F.count(F.lit(1)).alias("_n"))
        .filter("_n > 1")
        .select("_len", "_pre", F.lit(True).alias("_alive")),
        "prefixes",
    )
    rows = docs.select(
        F.col(id_col).alias("_id"), text.alias("_text"), F.struct(*carry).alias("_row"), *_keys(text)
    )
    if alive.count() <= BROADCAST_ROWS:
        rows = rows.join(F.broadcast(alive), ["_len", "_pre"], "left")
        full = F.when(F.col("_alive"), F.sha2("_text", 256))
    else:
        full = F.sha2("_text", 256)
    hashed = materialize(
        rows.select("_id", "_row", full.alias("_hash"), F.monotonically_increasing_id().alias("_at")),
        "hashed",
    )
    groups = materialize(
        hashed.filter("_hash is not null")
        .groupBy("_hash")
        .agg(F.count(F.lit(1)).alias("_n"), F.max(F.struct("_id", "_at")).alias("_keep"))
        .filter("_n > 1"),
        "groups",
    )
    told = attach(hashed, groups, ["_hash"], "_n", hashed.count())
    alone = F.col("_n").isNull()
    return carried(
        told,
        F.when(alone, F.col("_id")).otherwise(F.col("_keep._id")).alias("keep_id"),
        F.coalesce("_n", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("_keep._at") == F.col("_at"))).alias("kept"),
    )


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The group of every document, with the hash of its text."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "text", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256")
    )
    return exact_groups(docs, carry=("doc_id", "text_sha256")).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256"
    )
