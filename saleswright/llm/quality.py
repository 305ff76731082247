"""Quality classification with learned subword embeddings.

Words and the character n-grams inside them are hashed to ``BUCKETS`` vectors;
a text is the mean of the vectors of all its words and n-grams, and a softmax
over that mean gives the probability of the label. Vectors and weights are
learned by stochastic gradient descent on a bounded sample of labelled rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from math import exp

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from saleswright.llm.common import carried, crc_rest, table, text_bytes
from saleswright.llm.pieces import Memo

BUCKETS = 1 << 15
SIZE = 8
GRAM_CHARS = (2, 3, 4)
#: Labelled rows the classifier is fitted on; documented bound.
FIT_ROWS = 6000
EPOCHS = 12
#: Steps at least; few rows are gone over more often than ``EPOCHS`` times.
LEAST_STEPS = 3000
RATE = 0.5
BATCH = 16
SEED = 7
#: Score from which a text is predicted to be good.
KEEP_SCORE = 0.7
#: A word that only repeats the word before it also counts as this feature.
_AGAIN = BUCKETS - 1


def bucket(feature: bytes) -> int:
    return xxhash.xxh32_intdigest(feature) % _AGAIN


def grams(word: bytes) -> list[bytes]:
    """The different n-grams of a word's characters between two marks, in UTF-8.

    A byte that belongs to no character counts as one.
    """
    marked = b"<" + word + b">"
    if not marked.isascii():
        text = marked.decode("utf-8", "surrogateescape")
        found = dict.fromkeys([text[i : i + n] for n in GRAM_CHARS for i in range(len(text) - n + 1)])
        return [gram.encode("utf-8", "surrogateescape") for gram in found]
    return list(dict.fromkeys([marked[i : i + n] for n in GRAM_CHARS for i in range(len(marked) - n + 1)]))


def features(word: bytes) -> list[int]:
    """Buckets of a word and of its n-grams."""
    return [bucket(b"w" + word), *map(bucket, grams(word))]


def bag(data: bytes, memo: Memo) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a text and the share of all its features in each."""
    words = data.split()
    found = [b for word in words for b in memo[word]]
    found += [_AGAIN] * sum(a == b for a, b in zip(words, words[1:]))
    buckets, counts = np.unique(np.array(found, np.int32), return_counts=True)
    return buckets, (counts / max(1, len(found))).astype(np.float32)


@dataclass(frozen=True)
class QualityModel:
    """For each bucket, what its vector adds to the log odds of label 1."""

    weights: np.ndarray
    bias: float


def fit(bags: Sequence[tuple[np.ndarray, np.ndarray]], labels: Sequence[int]) -> QualityModel:
    """Stochastic gradient descent on vectors and softmax weights."""
    rng = np.random.default_rng(SEED)
    vectors = rng.uniform(-1 / SIZE, 1 / SIZE, (BUCKETS, SIZE)).astype(np.float32)
    out = np.zeros((SIZE, 2), np.float32)
    truth = np.eye(2, dtype=np.float32)[np.asarray(labels, int)]
    odds = np.log((truth.sum(axis=0) + 1) / (len(truth) + 2)).astype(np.float32)
    in_epoch = -(-len(bags) // BATCH)
    epochs = max(EPOCHS, -(-LEAST_STEPS // in_epoch))
    steps = epochs * in_epoch
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(bags))
        for at in range(0, len(order), BATCH):
            some = order[at : at + BATCH]
            rate = RATE * (1 - step / steps)
            step += 1
            buckets = np.concatenate([bags[k][0] for k in some])
            shares = np.concatenate([bags[k][1] for k in some])
            owner = np.repeat(np.arange(len(some)), [len(bags[k][0]) for k in some])
            mean = np.zeros((len(some), SIZE), np.float32)
            np.add.at(mean, owner, vectors[buckets] * shares[:, None])
            logits = mean @ out + odds
            logits -= logits.max(axis=1, keepdims=True)
            probability = np.exp(logits)
            probability /= probability.sum(axis=1, keepdims=True)
            error = probability - truth[some]
            back = error @ out.T
            out -= rate * (mean.T @ error)
            odds -= rate / len(some) * error.sum(axis=0)
            np.add.at(vectors, buckets, -rate * SIZE * back[owner] * shares[:, None])
    return QualityModel(vectors @ (out[:, 1] - out[:, 0]), float(odds[1] - odds[0]))


class Scorer:
    """Scores texts; what a word adds is worked out once."""

    def __init__(self, model: QualityModel):
        self.model = model
        self.memo = Memo(self._word)
        self.grams = Memo(self._weight)

    def _weight(self, feature: bytes) -> float:
        return float(self.model.weights[bucket(feature)])

    def _word(self, word: bytes) -> tuple[float, int]:
        found = grams(word)
        total = self._weight(b"w" + word) + sum(map(self.grams.__getitem__, found))
        return total, len(found) + 1

    def score(self, data: bytes) -> float:
        """Probability of label 1."""
        words = data.split()
        memo = self.memo
        found = [memo[word] for word in words]
        again = sum([a == b for a, b in zip(words, words[1:])])
        total = sum([a for a, _ in found]) + again * float(self.model.weights[_AGAIN])
        count = sum([n for _, n in found]) + again
        odds = self.model.bias + total / max(1, count)
        return 1 / (1 + exp(-odds)) if odds > -500 else 0.0


def train(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> QualityModel | None:
    """Fit on at most ``fit_rows`` labelled rows, drawn by a hash of the id.

    ``labels`` has ``_id`` and ``_label`` (0 or 1), ``docs`` has ``_id`` and
    ``_text``. The sample of ids is broadcast; texts become bags on the
    executors, so the driver gets ``BUCKETS`` numbers a row at most. A document
    with several labels counts with each. None if nothing is labelled.
    """
    known = labels.filter("_id is not null and _label in (0, 1)")
    n = known.count()
    if not n:
        return None
    draw = F.xxhash64("_id").bitwiseAND(F.lit((1 << 30) - 1)) / float(1 << 30)
    sample = known.filter(draw * n < 2 * fit_rows).orderBy(F.xxhash64("_id"), "_id", "_label").limit(fit_rows)
    rows = docs.join(F.broadcast(sample), "_id").select("_id", "_label", "_text")

    def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = Memo(features)
        for batch in batches:
            made = [bag(text.as_py(), memo) for text in batch.column("_text")]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_id").cast(pa.string()),
                    batch.column("_label"),
                    pa.array([a.tobytes() for a, _ in made], pa.binary()),
                    pa.array([b.tobytes() for _, b in made], pa.binary()),
                ],
                ["id", "label", "buckets", "shares"],
            )

    schema = "id string, label int, buckets binary, shares binary"
    found = rows.mapInArrow(bags, schema).orderBy("id", "label", "buckets").limit(fit_rows).collect()
    if not found:
        return None
    made = [(np.frombuffer(r.buckets, np.int32), np.frombuffer(r.shares, np.float32)) for r in found]
    return fit(made, [r.label for r in found])


def quality_scores(
    docs: DataFrame,
    labels: DataFrame,
    learn: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    carry: Sequence[str] = ("doc_id",),
    fit_rows: int = FIT_ROWS,
) -> DataFrame:
    """Probability that a text has label 1, for every whole text.

    Labels are learned from the rows of ``labels`` where ``learn`` (on its id)
    holds; labels other than 0 and 1 are passed over. Only the text decides a
    score: null and empty ones score what the bias alone gives, and without any
    label all score 0.5. Returns the ``carry`` columns and ``score``.
    """
    model = train(
        docs.select(F.col(id_col).alias("_id"), text_bytes(text_col).alias("_text")),
        labels.filter(learn).select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_label")),
        fit_rows,
    )
    model = model or QualityModel(np.zeros(BUCKETS, np.float32), 0.0)
    rows = docs.select(F.struct(*carry).alias("_row"), text_bytes(text_col).alias("_text"))
    schema = StructType([rows.schema["_row"], StructField("score", DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in batches:
            scores = [scorer.score(text.as_py()) for text in batch.column("_text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("_row"), pa.array(scores, pa.float64())], schema.names
            )

    return carried(rows.mapInArrow(run, schema), "score")


def held_out(id_col: str = "doc_id") -> Column:
    """Documents whose labels are never learned."""
    return crc_rest(id_col, 4) == 2


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    found = quality_scores(
        table(spark, sf_dir, "documents").select("doc_id", "text"),
        table(spark, sf_dir, "labels"),
        ~held_out(),
    )
    return found.select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        F.when(F.col("score") >= KEEP_SCORE, 1).otherwise(0).alias("predicted"),
    )
