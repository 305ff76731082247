"""Near duplicates by SimHash fingerprints that share a block."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from saleswright.llm.common import attach, carried, table, text_bytes
from saleswright.llm.components import connected_components
from saleswright.storage import materialize

SHINGLE_WORDS = 4
MOST_BITS = 4
SEED = 42
#: Members from which a block's pairs are found by flipped bits, not by a join.
DENSE_BLOCK = 512
#: Shingles whose bits are counted at a time.
_CHUNK = 1 << 16


def fingerprint(data: bytes, size: int = SHINGLE_WORDS) -> int:
    """SimHash of a text's word shingles: a bit is 1 if over half the hashes have it."""
    words = data.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= size:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = (ends[: len(words) - size + 1] - [len(w) + 1 for w in words[: len(words) - size + 1]]).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array(
        [digest(joined[a:b], SEED) for a, b in zip(starts, (ends[size - 1 :] - 1).tolist())],
        np.uint64,
    )
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), _CHUNK):
        part = hashes[at : at + _CHUNK]
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [fingerprint(x.as_py()) for x in batch.column("_text")]
        prints = pa.array(np.array(found, np.uint64).view(np.int64))
        columns = [batch.column("_id"), batch.column("_row"), prints]
        yield pa.RecordBatch.from_arrays(columns, ["_id", "_row", "fp"])


def _slices(blocks: int) -> list[tuple[int, int]]:
    """First bit and width of each of the blocks that make up 64 bits."""
    edges = [round(64 * i / blocks) for i in range(blocks + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def blocks_for(prints: int, most_bits: int = MOST_BITS) -> int:
    """Number of blocks for so many fingerprints.

    Of b blocks, b - most_bits are equal in any close pair, whatever b is, so b
    changes the work and never the result. More blocks make longer, rarer keys:
    the least b whose chance partners stay under four a fingerprint is taken.
    """
    for blocks in range(most_bits + 1, most_bits + 5):
        width = sum(sorted(w for _, w in _slices(blocks))[: blocks - most_bits])
        if prints * comb(blocks, most_bits) <= 4 * 2.0**width:
            return blocks
    return most_bits + 4


def _block_keys(blocks: int, most_bits: int) -> Column:
    """All (mask, masked fingerprint) keys; close fingerprints share at least one."""
    keys = []
    for chosen in combinations(_slices(blocks), blocks - most_bits):
        mask = sum(((1 << w) - 1) << a for a, w in chosen)
        signed = mask - (1 << 64) if mask >> 63 else mask
        keys.append(
            F.struct(F.lit(len(keys)).alias("c"), F.col("fp").bitwiseAND(F.lit(signed).cast("long")).alias("key"), F.lit(signed).cast("long").alias("mask"))
        )
    return F.explode(F.array(*keys))


def _flips(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each fingerprint with every way to flip up to half the bits outside its key."""
    for batch in batches:
        masks = batch.column("mask").to_numpy()
        prints = batch.column("fp").to_numpy()
        for mask in np.unique(masks):
            at = np.flatnonzero(masks == mask)
            free = [1 << b for b in range(64) if not (int(mask) >> b) & 1]
            flips = [0]
            for n in range(1, (MOST_BITS + 1) // 2 + 1):
                flips += [sum(x) for x in combinations(free, n)]
            flips = np.array(flips, np.uint64).view(np.int64)
            for some in np.array_split(at, len(at) // 256 + 1):
                if not len(some):
                    continue
                columns = {
                    name: pa.array(np.repeat(batch.column(name).to_numpy()[some], len(flips)))
                    for name in ("c", "key", "fp")
                }
                columns["near"] = pa.array((prints[some][:, None] ^ flips[None, :]).ravel())
                yield pa.RecordBatch.from_pydict(columns)


def links(prints: DataFrame) -> DataFrame:
    """Edges that connect fingerprints of at most ``MOST_BITS`` differing bits.

    ``prints`` has distinct ``fp``. Blocks with few members are joined with
    themselves and each pair is verified. In a block of more than
    ``DENSE_BLOCK`` members every member names all values within half the
    distance; two are close exactly if they name a common value, and all that
    name one are linked to the least of them. That grows with the members, not
    with their pairs, and connects the same fingerprints.
    """
    count = prints.count()
    keyed = prints.select("fp", _block_keys(blocks_for(count), MOST_BITS)).select("fp", "col.*")
    blocks = materialize(
        keyed.groupBy("c", "key").agg(F.count(F.lit(1)).alias("members")).filter("members > 1"),
        "blocks",
    )
    total = max(1, count * comb(blocks_for(count), MOST_BITS))
    shared = materialize(
        attach(keyed, blocks, ["c", "key"], "members", total).filter("members is not null"), "shared"
    )
    few = shared.filter(F.col("members") <= DENSE_BLOCK)
    left, right = few.select("c", "key", F.col("fp").alias("u")), few.select("c", "key", F.col("fp").alias("v"))
    close = F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= MOST_BITS
    joined = left.join(right, ["c", "key"]).filter((F.col("u") > F.col("v")) & close).select("u", "v")
    dense = shared.filter(F.col("members") > DENSE_BLOCK).select("c", "key", "mask", "fp")
    near = dense.mapInArrow(_flips, "c int, key long, fp long, near long")
    near = materialize(near, "near")
    least = (
        near.groupBy("c", "key", "near")
        .agg(F.min("fp").alias("v"), F.count(F.lit(1)).alias("members"))
        .filter("members > 1")
    )
    stars = near.join(least, ["c", "key", "near"]).select(F.col("fp").alias("u"), "v")
    return joined.union(stars.filter("u <> v"))


def near_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: Sequence[str] = ("doc_id",),
) -> DataFrame:
    """Fingerprint and component of every row.

    Words are runs of anything but ASCII white space, A-Z in lower case;
    shingles are ``SHINGLE_WORDS`` words, repeats included; a shorter text is
    one shingle, one without words (or null) has fingerprint zero and is linked
    like any other. Rows whose fingerprints differ in at most ``MOST_BITS``
    bits are linked, and ``component_id`` is the smallest id reachable (null
    ids are passed over; null if there are only such). One row of a component
    stays: that with this id, of several any one. Equal fingerprints are merged
    before anything is joined, so copies cost nothing.

    Returns the ``carry`` columns, ``fp`` (long), ``component_id``, ``stays``.
    """
    rows = docs.select(
        F.col(id_col).alias("_id"), F.struct(*carry).alias("_row"), text_bytes(text_col).alias("_text")
    )
    schema = StructType([rows.schema["_id"], rows.schema["_row"], StructField("fp", LongType())])
    marked = rows.mapInArrow(_fingerprints, schema)
    marked = materialize(marked.withColumn("_at", F.monotonically_increasing_id()), "fingerprints")
    least = F.struct(F.col("_id").isNull().alias("none"), F.col("_id").alias("id"), F.col("_at").alias("at"))
    prints = materialize(
        marked.groupBy("fp").agg(F.min(least).alias("least"), F.count(F.lit(1)).alias("size")), "prints"
    )
    roots = connected_components(links(prints.select("fp")))
    rooted = prints.join(roots, prints.fp == roots.node, "left").select(
        "fp", "least", "size", F.coalesce("root", "fp").alias("root")
    )
    rooted = materialize(rooted, "rooted")
    linked = rooted.groupBy("root").agg(F.min("least").alias("first"), F.count(F.lit(1)).alias("n"))
    named = attach(rooted, materialize(linked, "linked"), ["root"], "n", rooted.count())
    named = materialize(named.select("fp", "size", "first"), "named")
    return carried(
        attach(marked, named, ["fp"], "size", marked.count()),
        "fp",
        F.col("first.id").alias("component_id"),
        (F.col("first.at") == F.col("_at")).alias("stays"),
    )


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = near_groups(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )
