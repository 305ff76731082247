"""Removal of long byte strings that occur more than once in a corpus.

Every window of ``LENGTH`` bytes is told by its anchor: the ``GRAM``-byte string
in it whose hash is least, the first of equal ones. Equal windows have the same
anchor at the same place, so only windows with an anchor that occurs elsewhere
can repeat. The windows of a text that follow each other and share an anchor
are one context. Contexts that occur more than once repeat as a whole. The
distinct contexts of an anchor meet in one shard, where a run-length index of
their texts streams matching lengths and marks those of ``LENGTH`` or more.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from hashlib import sha256

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from saleswright.llm.common import BROADCAST_ROWS, attach, carried, table, text_bytes
from saleswright.llm.run_index import build
from saleswright.storage import materialize

LENGTH = 200
GRAM = 32
#: Text that is hashed at a time; longer texts go on in pieces that overlap.
_PIECE = 1 << 19
#: Bytes of contexts that are indexed together; an anchor is never split.
SHARD_BYTES = 1 << 20
#: Distinct contexts up to which an anchor is indexed. A commoner anchor's
#: windows are compared one by one by a hash, which no number of them stalls.
ANCHOR_CONTEXTS = 2000
_BETWEEN = 256

_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def _byte_codes() -> np.ndarray:
    return np.random.default_rng(200).integers(0, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)


_CODES = _byte_codes()


def gram_hashes(data: np.ndarray, size: int = GRAM) -> np.ndarray:
    """Hash of the ``size`` bytes from every position on; size is a power of two."""
    with np.errstate(over="ignore"):
        h, factor, width = _CODES[data], _FACTOR, 1
        while width < size:
            h = h[:-width] * factor + h[width:]
            factor, width = factor * factor, width * 2
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
    return h


def first_least(h: np.ndarray, width: int) -> np.ndarray:
    """Position of the least, the first of equal ones, in every run of ``width``."""
    value, at = h, np.arange(len(h), dtype=np.int32)
    size = 1
    while size < width:
        shift = min(size, width - size)
        later = value[shift:] < value[:-shift]
        value = np.where(later, value[shift:], value[:-shift])
        at = np.where(later, at[shift:], at[:-shift])
        size += shift
    return at


def pieces(texts: Sequence[bytes]) -> Iterator[list[tuple[int, int, bytes]]]:
    """Groups of (text number, offset, bytes) of bounded size.

    A long text goes on in pieces that share ``LENGTH - 1`` bytes, so every
    window lies in exactly one piece.
    """
    group: list[tuple[int, int, bytes]] = []
    size = 0
    for number, data in enumerate(texts):
        for at in range(0, max(1, len(data) - LENGTH + 1), _PIECE):
            part = data[at : at + _PIECE + LENGTH - 1]
            if len(part) < LENGTH:
                continue
            if group and size + len(part) > _PIECE:
                yield group
                group, size = [], 0
            group.append((number, at, part))
            size += len(part)
    if group:
        yield group


def contexts(group: list[tuple[int, int, bytes]]) -> tuple[np.ndarray, ...]:
    """Text number, place, size, anchor and hash of every context of the pieces."""
    joined = b"".join(part for _, _, part in group)
    data = np.frombuffer(joined, np.uint8)
    sizes = np.array([len(part) for _, _, part in group])
    starts = np.cumsum(sizes) - sizes
    h = gram_hashes(data)
    anchor = first_least(h, LENGTH - GRAM + 1)
    owner = np.repeat(np.arange(len(group), dtype=np.int32), sizes)
    windows = np.flatnonzero(owner[: len(anchor)] == owner[LENGTH - 1 :])
    anchor, owner = anchor[windows], owner[windows]
    new = np.ones(len(windows), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1])
    begin = np.flatnonzero(new)
    count = np.diff(np.append(begin, len(windows)))
    lo, whose = windows[begin], owner[begin]
    size = count + LENGTH - 1
    digest = xxhash.xxh3_64_intdigest
    own = [digest(joined[a:b]) for a, b in zip(lo.tolist(), (lo + size).tolist())]
    numbers = np.array([n for n, _, _ in group])[whose]
    place = lo - starts[whose] + np.array([at for _, at, _ in group])[whose]
    return numbers, place, size, h[anchor[begin]].view(np.int64), np.array(own, np.uint64).view(np.int64)


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        tids = batch.column("tid")
        texts = batch.column("text").to_pylist()
        for group in pieces(texts):
            numbers, place, size, key, context = contexts(group)
            yield pa.RecordBatch.from_arrays(
                [
                    tids.take(pa.array(numbers)),
                    pa.array(place.astype(np.int64)),
                    pa.array(size.astype(np.int32)),
                    pa.array(key),
                    pa.array(context),
                ],
                ["tid", "lo", "size", "key", "context"],
            )


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the contexts that are asked for of each text."""
    for batch in batches:
        for text, asked in zip(batch.column("text"), batch.column("asked")):
            data = text.as_py()
            rows = asked.as_py()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([x["key"] for x in rows], pa.int64()),
                    pa.array([x["context"] for x in rows], pa.int64()),
                    pa.array([x["copies"] for x in rows], pa.int64()),
                    pa.array([x["kinds"] for x in rows], pa.int64()),
                    pa.array([data[x["lo"] : x["lo"] + x["size"]] for x in rows], pa.binary()),
                ],
                ["key", "context", "copies", "kinds", "data"],
            )


def repeated_spans(texts: Sequence[bytes]) -> list[list[tuple[int, int]]]:
    """The parts of each text that windows found elsewhere among the texts cover."""
    codes = []
    for data in texts:
        codes += [np.frombuffer(data, np.uint8).astype(np.int16), np.array([_BETWEEN], np.int16)]
    lengths = build(np.concatenate(codes)).matching_lengths()
    found, at = [], 0
    for data in texts:
        marked = np.flatnonzero(lengths[at : at + len(data) - LENGTH + 1] >= LENGTH)
        found.append(covered(marked))
        at += len(data) + 1
    return found


def covered(windows: np.ndarray) -> list[tuple[int, int]]:
    """Bytes that sorted window starts cover, as runs that do not touch."""
    if not len(windows):
        return []
    gaps = np.flatnonzero(np.diff(windows) > LENGTH)
    starts = windows[np.concatenate([[0], gaps + 1])]
    ends = windows[np.concatenate([gaps, [len(windows) - 1]])] + LENGTH
    return list(zip(starts.tolist(), ends.tolist()))


_SPANS = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))


def _index_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Index whole anchors together, up to ``SHARD_BYTES`` at a time."""

    def found(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
        spans = repeated_spans([data for _, _, data in rows])
        return pa.RecordBatch.from_arrays(
            [
                pa.array([r[0] for r in rows], pa.int64()),
                pa.array([r[1] for r in rows], pa.int64()),
                pa.array([[{"a": a, "b": b} for a, b in s] for s in spans], _SPANS),
            ],
            ["key", "context", "spans"],
        )

    rows: list[tuple[int, int, bytes]] = []
    size = 0
    for batch in batches:
        for key, context, data in zip(*[batch.column(c).to_pylist() for c in ("key", "context", "data")]):
            if size >= SHARD_BYTES and key != rows[-1][0]:
                yield found(rows)
                rows, size = [], 0
            rows.append((key, context, data))
            size += len(data)
    if rows:
        yield found(rows)


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every window of the contexts with 128 bits of hash."""
    for batch in batches:
        for key, context, data in zip(*[batch.column(c).to_pylist() for c in ("key", "context", "data")]):
            n = len(data) - LENGTH + 1
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([key] * n, pa.int64()),
                    pa.array([context] * n, pa.int64()),
                    pa.array(range(n), pa.int32()),
                    pa.array([xxhash.xxh3_128_digest(data[i : i + LENGTH]) for i in range(n)], pa.binary()),
                ],
                ["key", "context", "at", "print"],
            )


def _common_anchors(cut: DataFrame) -> DataFrame:
    """Spans of the contexts of anchors too common for one shard."""
    rows = cut.select("key", "context", "data")
    windows = materialize(rows.mapInArrow(_windows, "key long, context long, at int, print binary"), "windows")
    twice = materialize(
        windows.groupBy("print").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "twice"
    )
    hits = attach(windows, twice, ["print"], "n", windows.count()).filter("n is not null")
    spans = F.collect_list(F.struct(F.col("at").alias("a"), (F.col("at") + LENGTH).alias("b")))
    return hits.groupBy("key", "context").agg(spans.alias("spans"))


def _marked(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for text, spans in zip(batch.column("_text"), batch.column("spans")):
            data = text.as_py()
            runs: list[list[int]] = []
            for x in sorted(spans.as_py() or (), key=lambda x: (x["lo"], x["hi"])):
                if runs and x["lo"] <= runs[-1][1]:
                    runs[-1][1] = max(runs[-1][1], x["hi"])
                else:
                    runs.append([x["lo"], x["hi"]])
            kept = sha256()
            at = 0
            for lo, hi in runs:
                kept.update(data[at:lo])
                at = hi
            kept.update(data[at:])
            removed = sum(hi - lo for lo, hi in runs)
            rows.append((len(data), removed, len(runs), kept.hexdigest(), runs))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("_row"),
                *[pa.array([r[k] for r in rows], pa.int64()) for k in range(3)],
                pa.array([r[3] for r in rows], pa.string()),
                pa.array([[{"lo": a, "hi": b} for a, b in r[4]] for r in rows], _REMOVED),
            ],
            names,
        )


_REMOVED = pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())]))


def _tid(text: Column) -> Column:
    return F.unhex(F.md5(text))


def _with_rows(rows: DataFrame, found: DataFrame, total: int) -> DataFrame:
    """Rows with the spans found for their text; texts without any do not travel.

    If few texts have spans, their ids are broadcast to part the rows.
    """
    if found.count() > BROADCAST_ROWS:
        return attach(rows, found, ["tid"], "copies", total).drop("copies")
    ids = F.broadcast(found.select("tid"))
    hit = attach(rows.join(ids, "tid", "left_semi"), found, ["tid"], "copies", total).drop("copies")
    return hit.unionByName(rows.join(ids, "tid", "left_anti"), allowMissingColumns=True)


def repeats(
    docs: DataFrame, text_col: str = "text", carry: Sequence[str] = ("doc_id",)
) -> DataFrame:
    """Bytes of every text that a string of ``LENGTH`` bytes found elsewhere covers.

    Texts are UTF-8 bytes, null ones empty; a match never goes over the end of
    a text. "Elsewhere" is any other start, in the same text or another row;
    rows with equal texts are elsewhere to each other. All is judged on the
    input, and overlapping strings count. Texts shorter than ``LENGTH`` have
    none. Texts are known by the 128 bits of their MD5.

    Returns the ``carry`` columns, ``n_bytes``, ``n_removed``, ``n_spans``,
    ``kept_sha256`` and ``removed`` (byte ranges, end exclusive).
    """
    text = text_bytes(text_col)
    source = docs.select(_tid(text).alias("tid"), text.alias("text"))
    schema = "tid binary, lo long, size int, key long, context long"
    seen = materialize(
        source.filter(F.length("text") >= LENGTH).mapInArrow(_contexts, schema), "contexts"
    )
    total = seen.count()
    keys = materialize(
        seen.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "anchors"
    )
    shared = materialize(
        attach(seen, keys, ["key"], "n", total).filter("n is not null").drop("n"), "shared"
    )
    kinds = materialize(
        shared.groupBy("key", "context").agg(
            F.count(F.lit(1)).alias("copies"), F.min(F.struct("tid", "lo", "size")).alias("at")
        ),
        "kinds",
    )
    # Where all contexts of an anchor have copies there is nothing left to find.
    open_keys = materialize(
        kinds.groupBy("key")
        .agg(F.count(F.lit(1)).alias("kinds"), F.min("copies").alias("least"))
        .filter("kinds > 1 and least = 1")
        .drop("least"),
        "open",
    )
    asked = attach(kinds, open_keys, ["key"], "kinds", max(1, kinds.count())).filter("kinds is not null")
    asked = materialize(
        asked.groupBy("at.tid").agg(
            F.collect_list(F.struct("key", "context", "copies", "kinds", "at.lo", "at.size")).alias("asked"),
            F.count(F.lit(1)).alias("n"),
        ),
        "asked",
    )
    rows = source.join(F.broadcast(asked.select("tid")), "tid", "left_semi") if asked.count() <= BROADCAST_ROWS else source
    cut = rows.join(asked, "tid").select("text", "asked").mapInArrow(
        _cut, "key long, context long, copies long, kinds long, data binary"
    )
    cut = materialize(cut.dropDuplicates(["key", "context"]), "cut")
    few = cut.filter(F.col("kinds") <= ANCHOR_CONTEXTS).repartition("key").sortWithinPartitions("key", "context")
    spans = "key long, context long, spans array<struct<a: int, b: int>>"
    found = few.select("key", "context", "data").mapInArrow(_index_shards, spans)
    found = found.unionByName(_common_anchors(cut.filter(F.col("kinds") > ANCHOR_CONTEXTS)))
    found = materialize(found.filter(F.size("spans") > 0), "spans")
    whole = F.array(F.struct(F.lit(0).alias("a"), F.col("at.size").alias("b")))
    marks = materialize(
        kinds.join(found, ["key", "context"], "left")
        .withColumn("spans", F.when(F.col("copies") > 1, whole).otherwise(F.col("spans")))
        .filter("spans is not null")
        .select("key", "context", "copies", "spans"),
        "marks",
    )
    spots = (
        attach(shared, marks, ["key", "context"], "copies", max(1, shared.count()))
        .filter("spans is not null")
        .groupBy("tid", "lo")
        .agg(F.first("spans").alias("spans"), F.count(F.lit(1)).alias("copies"))
    )
    by_text = spots.select(
        "tid",
        "copies",
        F.transform("spans", lambda x: F.struct((x.a + F.col("lo")).alias("lo"), (x.b + F.col("lo")).alias("hi"))).alias("spans"),
    )
    by_text = materialize(
        by_text.groupBy("tid").agg(
            F.flatten(F.collect_list("spans")).alias("spans"), F.max("copies").alias("copies")
        ),
        "by-text",
    )
    told = docs.select(F.struct(*carry).alias("_row"), text.alias("_text"), _tid(text).alias("tid"))
    rows = _with_rows(told, by_text, max(1, docs.count())).select("_row", "_text", "spans")
    out = StructType(
        [
            rows.schema["_row"],
            *[StructField(c, LongType()) for c in ("n_bytes", "n_removed", "n_spans")],
            StructField("kept_sha256", StringType()),
        ]
    )
    removed = docs.sparkSession.createDataFrame([], "removed array<struct<lo: long, hi: long>>").schema
    out = StructType([*out, *removed])
    names = out.names
    return carried(rows.mapInArrow(lambda batches: _marked(batches, names), out), *names[1:])


def op4_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is removed from every document as repeated, and a hash of the rest."""
    found = repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.drop("removed")
