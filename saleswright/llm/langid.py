"""Language identification with string kernels.

Two texts are as alike as the byte n-grams they share: the kernel is the number
of n-grams (one to three bytes, ASCII in lower case) present in both, over the
root of the product of their numbers. N-grams are hashed to ``BUCKETS``. A
bounded sample of rows gives Nyström landmarks and a ridge regression of each
language against the rest in their space; scoring is one product of a batch's
presence matrix with the landmarks' and one with the weights.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from saleswright.llm.common import carried, crc_rest, table, text_bytes
from saleswright.storage import materialize

BUCKETS = 1 << 13
GRAMS = (1, 2, 3)
LANDMARKS = 128
#: Rows the classifier is fitted on, over all languages; documented bound.
FIT_ROWS = 4096
#: Languages up to which the sample is even.
LANGUAGES = 10_000
RIDGE = 1e-2
UNKNOWN = "und"
#: Texts whose presence rows are multiplied at a time.
_BATCH = 256


def presence(data: bytes) -> np.ndarray:
    """Buckets of the n-grams of a text, with repeats."""
    text = np.frombuffer(data.lower(), np.uint8).astype(np.uint32)
    found = []
    code = text
    for n in range(1, max(GRAMS) + 1):
        if n > 1:
            code = (code[:-1] << np.uint32(8)) | text[n - 1 :]
        if n in GRAMS:
            mixed = (code + np.uint32(n * 0x1000003)) * np.uint32(2654435761)
            found.append(mixed >> np.uint32(32 - (BUCKETS.bit_length() - 1)))
    return np.concatenate(found)


def presence_matrix(texts: Sequence[bytes]) -> np.ndarray:
    """One row for each text, scaled to length one."""
    rows = np.zeros((len(texts), BUCKETS), np.float32)
    for row, data in zip(rows, texts):
        if data:
            row[presence(data)] = 1.0
            row /= np.sqrt(row.sum())
    return rows


@dataclass(frozen=True)
class LanguageModel:
    """Landmarks' presence rows, and weights from their space to languages."""

    languages: tuple[str, ...]
    landmarks: np.ndarray
    weights: np.ndarray
    bias: np.ndarray

    def margins(self, texts: Sequence[bytes]) -> np.ndarray:
        """About 1 for the language of a text and -1 for the others."""
        return presence_matrix(texts) @ self.landmarks @ self.weights + self.bias


def fit(rows: np.ndarray, languages: Sequence[str]) -> LanguageModel:
    """Nyström space of evenly drawn landmarks and a ridge regression in it."""
    names = tuple(sorted(set(languages)))
    truth = np.array([names.index(x) for x in languages])
    # Every language in turn gives a landmark, as long as it has rows left.
    turn = np.empty(len(truth), np.int64)
    for k in range(len(names)):
        own = np.flatnonzero(truth == k)
        turn[own] = np.arange(len(own))
    chosen = np.argsort(turn, kind="stable")[:LANDMARKS]
    landmarks = rows[chosen]
    values, vectors = np.linalg.eigh((landmarks @ landmarks.T).astype(np.float64))
    good = values > 1e-6 * values.max()
    root = vectors[:, good] / np.sqrt(values[good])
    space = rows.astype(np.float64) @ landmarks.T.astype(np.float64) @ root
    target = np.where(truth[:, None] == np.arange(len(names)), 1.0, -1.0)
    mean, bias = space.mean(axis=0), target.mean(axis=0)
    centred = space - mean
    gram = centred.T @ centred + RIDGE * len(rows) / len(chosen) * np.eye(space.shape[1])
    weights = np.linalg.solve(gram, centred.T @ (target - bias))
    return LanguageModel(
        names,
        np.ascontiguousarray(landmarks.T),
        (root @ weights).astype(np.float32),
        (bias - mean @ weights).astype(np.float32),
    )


def _drawn(docs: DataFrame, fit_rows: int) -> DataFrame:
    """A little more than ``fit_rows`` texts, about equally many of every language.

    A text counts once for each language, by its hash; rows of a drawn text all
    come. Only the languages' counts are broadcast, if there are at most
    ``LANGUAGES``; with more, texts are drawn whatever their language.
    """
    docs = docs.withColumn("hash", F.xxhash64("text"))
    texts = docs.groupBy("lang", "hash").agg(F.lit(1).alias("one"))
    counts = materialize(texts.groupBy("lang").agg(F.count(F.lit(1)).alias("n")), "languages")
    languages, total = counts.count(), counts.agg(F.sum("n")).first()[0] or 0
    draw = F.col("hash").bitwiseAND(F.lit((1 << 30) - 1)) / float(1 << 30)
    if languages > LANGUAGES:
        docs = docs.withColumn("n", F.lit(total)).withColumn("order", draw * total / (1.5 * fit_rows))
    else:
        share = F.col("n") * languages / (1.5 * fit_rows)
        docs = docs.join(F.broadcast(counts), "lang").withColumn("order", draw * share)
    return docs.filter("order < 1").select("lang", "text", "hash", "order")


def train(docs: DataFrame, learn: Column, fit_rows: int = FIT_ROWS) -> LanguageModel | None:
    """Fit on a bounded sample of the rows that may be learned from.

    Presence rows are made on the executors; one bit for each bucket travels,
    and the driver gets ``fit_rows`` times ``BUCKETS / 8`` bytes at most. ``docs``
    has ``text`` (bytes) and ``lang``. None if there is nothing to learn from.
    """
    rows = _drawn(
        docs.filter(learn & F.col("lang").isNotNull() & (F.octet_length("text") > 0)), fit_rows
    )

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            new, bits = [], []
            keys = zip(batch.column("lang").to_pylist(), batch.column("hash").to_pylist())
            for k, key in enumerate(keys):
                if key in seen:
                    continue
                seen.add(key)
                row = np.zeros(BUCKETS, bool)
                row[presence(batch.column("text")[k].as_py())] = True
                new.append(k)
                bits.append(np.packbits(row).tobytes())
            some = batch.select(["lang", "hash", "order"]).take(pa.array(new, pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [*some.columns, pa.array(bits, pa.binary())], ["lang", "hash", "order", "bits"]
            )

    made = rows.mapInArrow(packed, "lang string, hash long, order double, bits binary")
    # Copies that several tasks have met.
    once = made.groupBy("lang", "hash").agg(F.min("order").alias("order"), F.min("bits").alias("bits"))
    found = once.orderBy("order", "lang", "bits").limit(fit_rows).collect()
    if not found:
        return None
    bits = np.unpackbits(np.frombuffer(b"".join(r.bits for r in found), np.uint8))
    matrix = bits.reshape(len(found), BUCKETS).astype(np.float32)
    matrix /= np.sqrt(np.maximum(matrix.sum(axis=1, keepdims=True), 1))
    return fit(matrix, [r.lang for r in found])


def predict_language(
    docs: DataFrame,
    learn: Column,
    text_col: str = "text",
    lang_col: str = "lang",
    carry: Sequence[str] = ("doc_id",),
    fit_rows: int = FIT_ROWS,
) -> DataFrame:
    """Language of every whole text, learned from the rows where ``learn`` holds.

    Null texts and texts without a letter are ``und`` with score 0, and so is
    everything if no row can be learned from. The score is the winner's margin
    brought from [-1, 1] to [0, 1]; ties go to the first language by name. Only
    the text decides. Returns the ``carry`` columns, ``lang_pred``, ``score``.
    """
    model = train(
        docs.select(F.col(lang_col).alias("lang"), text_bytes(text_col).alias("text"), learn.alias("_learn")),
        F.col("_learn"),
        fit_rows,
    )
    rows = docs.select(
        F.struct(*carry).alias("_row"),
        F.when(F.col(text_col).rlike(r"\p{L}"), text_bytes(text_col)).alias("_text"),
    )
    schema = StructType(
        [rows.schema["_row"], StructField("lang_pred", StringType()), StructField("score", DoubleType())]
    )
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for whole in batches:
            for at in range(0, whole.num_rows, _BATCH):
                batch = whole.slice(at, _BATCH)
                texts = batch.column("_text").to_pylist()
                names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
                some = [k for k, text in enumerate(texts) if text is not None and known]
                if some:
                    margins = known.margins([texts[k] for k in some])
                    for k, best in zip(some, margins.argmax(axis=1)):
                        names[k] = known.languages[best]
                    scores[some] = np.clip((margins.max(axis=1) + 1) / 2, 0, 1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("_row"), pa.array(names, pa.string()), pa.array(scores)],
                    schema.names,
                )

    return carried(rows.mapInArrow(run, schema), "lang_pred", "score")


def op6_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from those that are not held out."""
    docs = table(spark, sf_dir, "documents").withColumn(
        "held_out", crc_rest("doc_id", 4) == 2
    )
    found = predict_language(docs, ~F.col("held_out"), carry=("doc_id", "held_out"))
    return found.select("doc_id", "held_out", "lang_pred", "score")
