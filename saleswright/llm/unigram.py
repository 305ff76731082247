"""Unigram encoding by Viterbi over a double-array trie, and decoding."""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator, Sequence
from hashlib import sha256

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)

from saleswright.llm.common import carried, kept, table
from saleswright.llm.pieces import MARKER, Memo, Vocabulary, load_vocabulary, units

MODEL = public_tokenizers.path("piece_bpe_32k.model")


#: Places tried in vain after which a stretch of the arrays counts as full.
_DENSE = 64


class DoubleArray:
    """A trie over bytes in three arrays.

    The child of ``node`` by byte ``b`` is ``base[node] + b + 1`` if ``check``
    there names ``node``; ``value`` holds the piece that ends at a node, or -1.
    """

    def __init__(self, keys: Sequence[tuple[bytes, int]]):
        root: dict = {}
        for key, value in keys:
            node = root
            for b in key:
                node = node.setdefault(b, {})
            node[-1] = value
        self.base, self.check, self.value = [0], [-1], [-1]
        free_from = 1
        queue = deque([(root, 0)])
        self.check[0] = 0
        while queue:
            children, at = queue.popleft()
            self.value[at] = children.get(-1, -1)
            codes = sorted(b + 1 for b in children if b >= 0)
            if not codes:
                continue
            while free_from < len(self.check) and self.check[free_from] >= 0:
                free_from += 1
            first = base = max(free_from - codes[0], 0)
            while not self._fits(base, codes):
                base += 1
            if base - first > _DENSE:
                free_from = base
            self.base[at] = base
            for code in codes:
                self.check[base + code] = at
                queue.append((children[code - 1], base + code))

    def _fits(self, base: int, codes: list[int]) -> bool:
        missing = base + codes[-1] + 1 - len(self.check)
        if missing > 0:
            self.base += [0] * missing
            self.check += [-1] * missing
            self.value += [-1] * missing
        return all(self.check[base + code] < 0 for code in codes)


def _char_bytes(lead: int) -> int:
    return 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4


class Encoder:
    """Best segmentation of texts, and back."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.trie = DoubleArray(
            [
                (p.encode(), i)
                for i, (p, ok) in enumerate(zip(vocabulary.pieces, vocabulary.usable))
                if ok and p
            ]
        )
        self.cuts = vocabulary.cuts_at_blanks
        self.memo = Memo(self._unit)
        self.bytes_of = [
            p.replace(MARKER, " ").encode() if ok else b""
            for p, ok in zip(vocabulary.pieces, vocabulary.usable)
        ]
        self.score_of = np.array(vocabulary.scores)
        for b, i in enumerate(vocabulary.byte_ids):
            self.bytes_of[i] = bytes([b])
            # The first byte of an unknown character carries its score.
            self.score_of[i] = vocabulary.unknown_score if b & 0xC0 != 0x80 else 0.0

    def segment(self, data: bytes) -> list[int]:
        """Ids of the best path; of equal ones, the piece that starts first wins."""
        base, check, value = self.trie.base, self.trie.check, self.trie.value
        scores, unknown = self.vocabulary.scores, self.vocabulary.unknown_score
        n, size = len(data), len(check)
        best = [float("-inf")] * (n + 1)
        came = [0] * (n + 1)
        by = [-1] * (n + 1)
        best[0] = 0.0
        at = 0
        while at < n:
            here = best[at]
            after = at + _char_bytes(data[at])
            node, single = 0, False
            for i in range(at, n):
                child = base[node] + data[i] + 1
                if child >= size or check[child] != node:
                    break
                node = child
                piece = value[node]
                if piece >= 0:
                    end = i + 1
                    if here + scores[piece] > best[end]:
                        best[end], came[end], by[end] = here + scores[piece], at, piece
                    single = single or end == after
            if not single and here + unknown > best[after]:
                best[after], came[after], by[after] = here + unknown, at, -1
            at = after
        ids: list[int] = []
        while n:
            if by[n] >= 0:
                ids.append(by[n])
            else:
                ids += [self.vocabulary.byte_ids[b] for b in reversed(data[came[n] : n])]
            n = came[n]
        return ids[::-1]

    def _unit(self, unit: str) -> bytes:
        return np.array(self.segment((MARKER + unit.replace(" ", MARKER)).encode()), "<u4").tobytes()

    def encode(self, text: str) -> np.ndarray:
        """Ids of a text, as unsigned 32-bit integers."""
        found = map(self.memo.__getitem__, units(text, self.cuts))
        return np.frombuffer(b"".join(found), "<u4")

    def decode(self, ids: np.ndarray) -> str:
        """Text of ids: markers become blanks, the first of which goes."""
        data = b"".join(map(self.bytes_of.__getitem__, ids.tolist()))
        return data.removeprefix(b" ").decode("utf-8", "replace")


def _encoder(vocabulary: Vocabulary) -> Encoder:
    return kept(("encoder", vocabulary.key), lambda: Encoder(vocabulary))


def encode(
    docs: DataFrame,
    text_col: str = "text",
    carry: Sequence[str] = ("doc_id",),
    model: str = MODEL,
    keep_ids: bool = True,
) -> DataFrame:
    """Unigram pieces of every whole text, and the text decoded from them.

    A marker is put before the text and blanks become markers; the path of the
    highest sum of scores is taken (in double precision, of equal paths the one
    whose pieces start first), and characters that no piece covers become byte
    pieces. No piece goes on after a marker, so words are encoded on their own
    and remembered. Null texts have null results, empty ones no pieces. A text
    with the marker character itself decodes with blanks in its place.

    Returns the ``carry`` columns, ``piece_ids`` (if ``keep_ids``),
    ``n_pieces``, ``ids_crc32`` (of little-endian 32-bit ids), ``score``,
    ``decoded_sha256`` and ``round_trip``.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(load_vocabulary(model))
    rows = docs.select(F.struct(*carry).alias("_row"), F.col(text_col).alias("_text"))
    schema = StructType(
        [rows.schema["_row"]]
        + ([StructField("piece_ids", ArrayType(IntegerType(), False))] if keep_ids else [])
        + [
            StructField("n_pieces", IntegerType()),
            StructField("ids_crc32", DoubleType()),
            StructField("score", DoubleType()),
            StructField("decoded_sha256", StringType()),
            StructField("round_trip", IntegerType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared.value)
        for batch in batches:
            ids, rest = [], []
            for text in batch.column("_text").to_pylist():
                if text is None:
                    ids.append(None)
                    rest.append((None,) * 5)
                    continue
                found = encoder.encode(text)
                back = encoder.decode(found)
                ids.append(found.view(np.int32))
                rest.append(
                    (
                        len(found),
                        float(zlib.crc32(found.tobytes())),
                        float(encoder.score_of[found].sum()),
                        sha256(back.encode()).hexdigest(),
                        int(back == text),
                    )
                )
            columns = [batch.column("_row")]
            if keep_ids:
                columns.append(pa.array(ids, pa.list_(pa.field("element", pa.int32(), False))))
            kinds = [pa.int32(), pa.float64(), pa.float64(), pa.string(), pa.int32()]
            columns += [pa.array([x[k] for x in rest], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    found = rows.mapInArrow(run, schema)
    own = {
        "n_pieces": F.col("n_pieces").cast("long"),
        "ids_crc32": F.col("ids_crc32").cast("long"),
        "round_trip": F.col("round_trip").cast("boolean"),
    }
    return carried(found, *[own.get(c, F.col(c)).alias(c) for c in schema.names[1:]])


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of every document as a digest, and whether they decode to its text."""
    return encode(table(spark, sf_dir, "documents"), keep_ids=False)
