"""Benchmark passages in documents, found by one automaton over word sequences."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from saleswright.llm.common import carried, kept, table, text_bytes
from saleswright.storage import materialize

WINDOW_WORDS = 13
#: A text is contaminated if one word in this many, or more, is hit.
HIT_SHARE = 20
#: Benchmark text that goes into one automaton; more text makes more automata,
#: which scan the documents one after the other.
AUTOMATON_BYTES = 2 << 20

#: Fixed value: bytes that are part of a word, after A-Z became a-z; the rest
#: becomes a blank, so that every word stays at its place.
WORD_BYTES = bytes(range(0x30, 0x3A)) + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100))
_FOLD = bytes(
    c if c in WORD_BYTES else c + 32 if 0x41 <= c <= 0x5A else 0x20 for c in range(256)
)

_FOUND = "array<struct<lo: long, hi: long, start: long, end: long>>"
_WORDS = r"""regexp_extract_all(
    translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""
ORACLE_SQL = f"""
WITH item AS (SELECT item_id, {_WORDS.format(text="text")} AS w FROM benchmark),
starts AS (SELECT item_id, w, least(len(w), {WINDOW_WORDS}) AS k,
             unnest(range(1, greatest(len(w) - {WINDOW_WORDS} + 1, 1) + 1)) AS i
           FROM item WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS s FROM starts),
doc AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS.format(text="text")} AS w
        FROM documents),
gram AS (SELECT r, k, w, unnest(range(1, len(w) - k + 2)) AS i
         FROM doc, (SELECT DISTINCT k FROM win)),
hit AS (SELECT r, item_id, i, k
        FROM (SELECT r, k, i, array_to_string(w[i:i + k - 1], ' ') AS s FROM gram)
        JOIN win USING (k, s)),
words AS (SELECT r, count(DISTINCT p) AS n_hit
          FROM (SELECT r, unnest(range(i, i + k)) AS p FROM hit) GROUP BY r),
items AS (SELECT r, count(DISTINCT item_id) AS n_items,
            string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
          FROM hit GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND {HIT_SHARE} * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN words USING (r) LEFT JOIN items USING (r)
"""


def words_of(data: bytes) -> tuple[bytes, list[bytes]]:
    """The folded text, as long as the original, and its words."""
    folded = data.translate(_FOLD)
    return folded, folded.split()


class Matcher:
    """One Aho-Corasick automaton over the word sequences of all windows."""

    def __init__(self, items: Sequence[tuple[str | None, bytes]]):
        self.numbers: dict[bytes, int] = {}
        windows: dict[tuple[int, ...], set[str | None]] = {}
        for item_id, data in items:
            words = words_of(data)[1]
            ids = tuple(self.numbers.setdefault(w, len(self.numbers) + 1) for w in words)
            size = min(len(ids), WINDOW_WORDS)
            for at in range(len(ids) - size + 1 if ids else 0):
                windows.setdefault(ids[at : at + size], set()).add(item_id)
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for window, owners in windows.items():
            self.automaton.add_word(window, (len(window), owners))
        self.empty = not windows
        if windows:
            self.automaton.make_automaton()

    def scan(self, data: bytes) -> tuple[int, list[tuple[int, int]], set[str | None], bytes]:
        """Number of words, merged hit word ranges, items met, and the folded text."""
        folded, words = words_of(data)
        ranges: list[tuple[int, int]] = []
        owners: set[str | None] = set()
        if words and not self.empty:
            get = self.numbers.get
            for last, (size, whose) in self.automaton.iter(tuple([get(w, 0) for w in words])):
                ranges.append((last + 1 - size, last + 1))
                owners |= whose
        return len(words), merge_ranges(ranges), owners, folded


def merge_ranges(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Ranges that touch or overlap become one."""
    merged: list[tuple[int, int]] = []
    for lo, hi in sorted(ranges):
        if merged and lo <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(hi, merged[-1][1]))
        else:
            merged.append((lo, hi))
    return merged


def _spans(data: bytes, folded: bytes, ranges: list[tuple[int, int]]) -> list[dict[str, int]]:
    """Word ranges with the characters of the original text that they cover."""
    blank = np.frombuffer(b" " + folded + b" ", np.uint8) == 0x20
    starts = np.flatnonzero(blank[:-2] & ~blank[1:-1])
    ends = np.flatnonzero(~blank[1:-1] & blank[2:]) + 1
    chars = np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)
    return [
        {
            "lo": lo,
            "hi": hi,
            "start": int(chars[starts[lo]]) - 1,
            "end": int(chars[ends[hi - 1] - 1]),
        }
        for lo, hi in ranges
    ]


def _matcher(key: str, items: Sequence[tuple[str | None, bytes]]) -> Matcher:
    return kept(("matcher", key), lambda: Matcher(items))


def _scan_with(rows: DataFrame, items: list[tuple[str | None, bytes]]) -> DataFrame:
    spark = rows.sparkSession
    key = hashlib.sha256(repr(items).encode()).hexdigest()
    shared = spark.sparkContext.broadcast(items)
    schema = StructType(list(rows.schema))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = _matcher(key, shared.value)
        for batch in batches:
            counts, found, met = [], [], []
            for text, before, owned in zip(
                batch.column("_text"),
                batch.column("_found").to_pylist(),
                batch.column("_items").to_pylist(),
            ):
                data = text.as_py()
                n, ranges, owners, folded = matcher.scan(data)
                if ranges and before:
                    ranges = merge_ranges(ranges + [(x["lo"], x["hi"]) for x in before])
                counts.append(n)
                found.append(_spans(data, folded, ranges) if ranges else before)
                met.append(sorted(set(owned) | {x for x in owners if x is not None}))
            columns = [
                batch.column("_row"),
                batch.column("_text"),
                pa.array(counts, pa.int64()),
                pa.array(found, batch.column("_found").type),
                pa.array(met, batch.column("_items").type),
            ]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return rows.mapInArrow(scan, schema)


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    carry: Sequence[str] = ("doc_id",),
    automaton_bytes: int = AUTOMATON_BYTES,
) -> DataFrame:
    """Words of every document that lie in a benchmark passage.

    Texts are split into words of digits, a-z and everything beyond ASCII, A-Z
    in lower case. Every run of ``WINDOW_WORDS`` words of an item is a window,
    a shorter item is one window, an item without words is none. Each document
    is scanned once by an automaton over the windows as word sequences; a
    benchmark of more than ``automaton_bytes`` is dealt over several automata
    of at most about that size, one scan each, and the hits are united; equal
    rows of the benchmark are one. Null
    texts have no words; items with a null id hit words but are not listed;
    rows with one item id are one item; an empty benchmark hits nothing.

    Returns the ``carry`` columns of ``docs``, ``n_words``, ``n_hit``,
    ``n_items``, ``item_ids`` (sorted texts), ``spans`` (character offsets in
    the original text, end exclusive) and ``contaminated``.
    """
    items = benchmark.select(
        F.col(item_col).cast("string").alias("item"), text_bytes(item_text_col).alias("text")
    )
    items = materialize(items.distinct(), "items")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = -(-size // automaton_bytes) or 1
    rows = docs.select(
        F.struct(*carry).alias("_row"),
        text_bytes(text_col).alias("_text"),
        F.lit(0).cast("long").alias("_n"),
        F.array().cast(_FOUND).alias("_found"),
        F.array().cast("array<string>").alias("_items"),
    )
    dealt = F.pmod(F.xxhash64("item", "text"), F.lit(parts))
    for part in range(parts):
        if part:
            rows = materialize(rows, "scanned")
        some = sorted(items.filter(dealt == part).collect(), key=repr)
        rows = _scan_with(rows, [(x.item, bytes(x.text)) for x in some])
    n_hit = F.aggregate("_found", F.lit(0).cast("long"), lambda n, x: n + x.hi - x.lo)
    return carried(
        rows.withColumn("_hit", n_hit),
        F.col("_n").alias("n_words"),
        F.col("_hit").alias("n_hit"),
        F.size("_items").cast("long").alias("n_items"),
        F.col("_items").alias("item_ids"),
        F.transform("_found", lambda x: F.struct(x.start.alias("start"), x.end.alias("end"))).alias("spans"),
        ((F.col("_hit") > 0) & (HIT_SHARE * F.col("_hit") >= F.col("_n"))).alias("contaminated"),
    )


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hits of every document, over the whole benchmark."""
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        "contaminated",
    )
