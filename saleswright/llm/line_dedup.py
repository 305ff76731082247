"""Repeated lines, found by range-partitioned hashes; results are bitmaps, not texts."""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField, StructType

from saleswright.llm.common import carried, table, text_bytes
from saleswright.storage import materialize

#: White space taken off both ends of a line (fixed value).
BLANK = b"\x20\x09\x0a\x0b\x0c\x0d"
#: Documents from which on a line goes, and code points it has at least, in the query.
LEAST_DOCS = 10
LEAST_CHARS = 1
#: Rows of a batch that a task gives back.
_ROWS = 1 << 14

_DROP, _OPEN, _COUNT = range(3)
_DOC = ("_id", "_print", "_size")

_BLANK_SQL = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
ORACLE_SQL = f"""
WITH texts AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), lines AS (
  SELECT doc_id, i, lines[i] AS line,
         translate(trim(lines[i], {_BLANK_SQL}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz') AS key
  FROM texts, unnest(range(1, len(lines) + 1)) t(i)
), common AS (
  SELECT key FROM lines WHERE len(key) >= {LEAST_CHARS}
  GROUP BY key HAVING count(DISTINCT doc_id) >= {LEAST_DOCS}
)
SELECT doc_id, count(*) AS n_lines, count(c.key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (c.key IS NULL), '')) AS kept_sha256
FROM lines l LEFT JOIN common c ON l.key = c.key
GROUP BY doc_id
"""


def line_key(line: bytes) -> bytes:
    """A line without white space at its ends, A-Z in lower case."""
    return line.strip(BLANK).lower()


def _code_points(key: bytes) -> int:
    return len(key) - sum(0x80 <= b < 0xC0 for b in key) if not key.isascii() else len(key)


def _places(schema: StructType, least_chars: int):
    """A row for every key of every document, with the places of its lines."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, keys, places = [], [], []
            for row, text in enumerate(batch.column("_text")):
                found: dict[bytes, list[int]] = {}
                for i, line in enumerate(text.as_py().split(b"\n")):
                    key = line_key(line)
                    if key and (least_chars <= 1 or _code_points(key) >= least_chars):
                        found.setdefault(key, []).append(i)
                for key, at in found.items():
                    rows.append(row)
                    keys.append(xxhash.xxh3_128_digest(key))
                    places.append(np.array(at, "<u4").tobytes())
                    if len(rows) >= _ROWS:
                        yield told(batch, rows, keys, places)
                        rows, keys, places = [], [], []
            if rows:
                yield told(batch, rows, keys, places)

    def told(batch: pa.RecordBatch, rows: list, keys: list, places: list) -> pa.RecordBatch:
        columns = [pa.array(keys, pa.binary()), *[batch.column(c).take(pa.array(rows)) for c in _DOC]]
        return pa.RecordBatch.from_arrays([*columns, pa.array(places, pa.binary())], schema.names)

    return run


class _Run:
    """A run of one key that may still go on: its first row, and rows not yet decided."""

    def __init__(self, key: bytes, rows: pa.Table, leading: bool, least_docs: int):
        self.key, self.leading, self.least = key, leading, least_docs
        self.first, self.held, self.n = rows.slice(0, 1), rows.slice(1), rows.num_rows

    def add(self, rows: pa.Table) -> None:
        self.held = pa.concat_tables([self.held, rows])
        self.n += rows.num_rows

    def decided(self) -> pa.Table:
        """Rows after the first that are known to go."""
        if self.n < self.least:
            return self.held.slice(0, 0)
        gone, self.held = self.held, self.held.slice(0, 0)
        return gone


def _stream(least_docs: int, keep_first: bool):
    """Decide sorted runs of equal keys: which lines go, and which is the first.

    Of a run only the first row is held back, and those before it is known to
    be long enough. The runs at a partition's two ends may go on in others:
    they give their counts, and the rows that are still open.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: _Run | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch])
            whole = b"".join(rows.column("key").to_pylist())
            keys = np.frombuffer(whole, np.uint64).reshape(-1, 2)
            starts = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(1)])
            sizes = np.diff(np.r_[starts, len(keys)])
            done, head = 0, rows.slice(0, sizes[0])
            if last is None or whole[:16] == last.key:
                if last is None:
                    last = _Run(whole[:16], head, True, least_docs)
                else:
                    last.add(head)
                done = 1
                yield from told(last.decided(), _DROP)
            if done == len(sizes):
                continue
            yield from close(last, edge=last.leading)
            n = sizes[done:-1]
            if len(n):
                begins = np.zeros(len(keys), bool)
                begins[starts] = True
                at = np.flatnonzero(np.repeat(n >= least_docs, n)) + starts[done]
                yield from told(rows.take(pa.array(at)), _DROP, begins[at])
            at = int(starts[-1])
            last = _Run(whole[16 * at : 16 * at + 16], rows.slice(at), False, least_docs)
            yield from told(last.decided(), _DROP)
        if last is not None:
            yield from close(last, edge=True)

    def close(last: _Run, edge: bool) -> Iterator[pa.RecordBatch]:
        if edge:
            yield from told(last.first, _COUNT, True, last.n)
            yield from told(last.first, _OPEN, True)
            yield from told(last.held, _OPEN)
        elif last.n >= least_docs:
            yield from told(last.first, _DROP, True)

    def told(rows: pa.Table, kind: int, first=False, n: int = 0) -> Iterator[pa.RecordBatch]:
        size = rows.num_rows
        if not size:
            return
        more = {
            "kind": pa.array(np.full(size, kind), pa.int32()),
            "first": pa.array(np.broadcast_to(first & keep_first, size).astype(np.int32), pa.int32()),
            "n": pa.array(np.full(size, n), pa.int64()),
        }
        for name, values in more.items():
            rows = rows.append_column(name, values)
        yield from rows.combine_chunks().to_batches()

    return run


def _bits(schema: StructType):
    """Number of lines, of dropped ones, and the bitmap of those that stay."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines, dropped, bits = [], [], []
            for n, places, firsts in zip(
                batch.column("_n").to_pylist(),
                batch.column("_places").to_pylist(),
                batch.column("_firsts").to_pylist(),
            ):
                keep = np.ones(n, bool)
                for blob in places or ():
                    keep[np.frombuffer(blob, "<u4")] = False
                for blob in firsts or ():
                    keep[np.frombuffer(blob, "<u4")[0]] = True
                lines.append(n)
                dropped.append(n - int(keep.sum()))
                bits.append(zlib.compress(np.packbits(keep, bitorder="little").tobytes(), 1))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_row"),
                    pa.array(lines, pa.int64()),
                    pa.array(dropped, pa.int64()),
                    pa.array(bits, pa.binary()),
                ],
                schema.names,
            )

    return run


def keep_lines(text: bytes, bits: bytes) -> bytes:
    """The lines of a text that its bitmap keeps, joined again."""
    lines = text.split(b"\n")
    keep = np.unpackbits(np.frombuffer(zlib.decompress(bits), np.uint8), count=len(lines), bitorder="little")
    if keep.all():
        return text
    return b"\n".join([line for line, stays in zip(lines, keep.tolist()) if stays])


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [
            keep_lines((text or "").encode(), bits)
            for text, bits in zip(batch.column("text").to_pylist(), batch.column("keep_bits").to_pylist())
        ]
        columns = [c for c in batch.schema.names if c not in ("text", "keep_bits")]
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(c) for c in columns], pa.array(texts, pa.binary())], [*columns, "kept"]
        )


def line_bitmaps(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: Sequence[str] = ("doc_id",),
    least_docs: int = 2,
    keep_first: bool = True,
    least_chars: int = LEAST_CHARS,
) -> DataFrame:
    """Which lines of each document stay when lines of several documents go.

    A text is split at ``\\n``; null or empty is one empty line. Lines are the
    same if their :func:`line_key` is (128 bits of a hash of it are compared).
    Keys of at least ``least_chars`` code points that ``least_docs`` documents
    or more have lose all their lines, but, with ``keep_first``, for the first
    line of the first document by id (null first) and text. Every row counts as
    a document; rows of the same id and text get the same bitmap.

    A row per key and document is sorted by hash, document and place over range
    partitions, so a key that very many documents have is spread over several,
    and runs are decided as they stream by. Only runs at the ends of partitions
    are added up, by key.

    Returns the ``carry`` columns, ``n_lines``, ``n_dropped`` and ``keep_bits``: the
    compressed bitmap, first line in the lowest bit, that :func:`keep_lines`
    applies. No rows give no rows.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    ident = [
        F.col(id_col).alias("_id"),
        F.xxhash64(text).alias("_print"),
        F.octet_length(text).cast("long").alias("_size"),
    ]
    rows = docs.select(*ident, text_bytes(text).alias("_text"))
    schema = StructType(
        [
            StructField("key", BinaryType()),
            *[rows.schema[c] for c in _DOC],
            StructField("places", BinaryType()),
        ]
    )
    found = materialize(rows.mapInArrow(_places(schema, least_chars), schema), "lines")
    order = ["key", *_DOC]
    more = [StructField("kind", IntegerType()), StructField("first", IntegerType()), StructField("n", LongType())]
    judged = materialize(
        found.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .mapInArrow(_stream(least_docs, keep_first), StructType([*schema.fields, *more])),
        "runs",
    )
    doc = F.struct(*_DOC)
    totals = (
        judged.filter(F.col("kind") == _COUNT)
        .groupBy("key")
        .agg(F.sum("n").alias("all"), F.min(doc).alias("least"))
        .filter(F.col("all") >= least_docs)
    )
    is_first = (F.col("first") == 1) & doc.eqNullSafe(F.col("least")) if keep_first else F.lit(False)
    open_rows = judged.filter(F.col("kind") == _OPEN).join(totals, "key").withColumn("first", is_first.cast("int"))
    sure = judged.filter(F.col("kind") == _DROP)
    gone = sure.select(*_DOC, "places", "first").union(open_rows.select(*_DOC, "places", "first"))
    # Sets: rows of the same id and text name the same places.
    marks = gone.groupBy(*_DOC).agg(
        F.collect_set("places").alias("_places"),
        F.collect_set(F.when(F.col("first") == 1, F.col("places"))).alias("_firsts"),
    )
    counted = docs.select(
        *ident,
        F.struct(*carry).alias("_row"),
        (F.octet_length(text) - F.octet_length(F.replace(text, F.lit("\n"), F.lit(""))) + 1).cast("long").alias("_n"),
    )
    mine, marks = counted.alias("d"), marks.alias("m")
    same = reduce(Column.__and__, [F.col(f"d.{c}").eqNullSafe(F.col(f"m.{c}")) for c in _DOC])
    joined = mine.join(marks, same, "left").select("d._row", "d._n", "m._places", "m._firsts")
    out = StructType(
        [
            joined.schema["_row"],
            StructField("n_lines", LongType()),
            StructField("n_dropped", LongType()),
            StructField("keep_bits", BinaryType()),
        ]
    )
    return carried(joined.mapInArrow(_bits(out), out), "n_lines", "n_dropped", "keep_bits")


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of every document, dropped ones, and the hash of what stays."""
    found = line_bitmaps(
        table(spark, sf_dir, "documents"),
        carry=("doc_id", "text"),
        least_docs=LEAST_DOCS,
        keep_first=False,
        least_chars=LEAST_CHARS,
    )
    kept = found.mapInArrow(_kept, "doc_id long, n_lines long, n_dropped long, kept binary")
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))
