"""Numbers of unigram tokens without the tokens."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from saleswright.llm.common import carried, kept, table
from saleswright.llm.pieces import MARKER, Memo, Vocabulary, load_vocabulary, units
from saleswright.llm.unigram import MODEL


class Counter:
    """Counts the pieces of the best segmentation.

    An Aho-Corasick automaton names all pieces that end at a character; the
    best score and its number of pieces are carried from end to end. Among
    equal scores the piece that starts first wins, as in the tokenizer.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.automaton = ahocorasick.Automaton()
        for piece, score, ok in zip(vocabulary.pieces, vocabulary.scores, vocabulary.usable):
            if ok and piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = vocabulary.unknown_score
        self.cuts = vocabulary.cuts_at_blanks
        self.memo = Memo(self._unit)

    def _unit(self, unit: str) -> tuple[int, float]:
        text = MARKER + unit.replace(" ", MARKER)
        ending: list[list[tuple[int, float]]] = [[] for _ in text]
        for last, match in self.automaton.iter(text):
            ending[last].append(match)
        best, count = [0.0], [0]
        for last, matches in enumerate(ending):
            top, pieces, from_ = float("-inf"), 0, 0
            single = False
            for size, score in matches:
                start = last + 1 - size
                total = best[start] + score
                if total > top or (total == top and start < from_):
                    top, pieces, from_ = total, count[start] + 1, start
                single = single or size == 1
            if not single and best[last] + self.unknown > top:
                top = best[last] + self.unknown
                pieces = count[last] + len(text[last].encode())
            best.append(top)
            count.append(pieces)
        return count[-1], best[-1]

    def count(self, text: str) -> tuple[int, float]:
        """Number of pieces of a text and their score."""
        memo = self.memo
        found = [memo[unit] for unit in units(text, self.cuts)]
        return sum([n for n, _ in found]), sum([s for _, s in found], 0.0)


def _counter(vocabulary: Vocabulary) -> Counter:
    return kept(("counter", vocabulary.key), lambda: Counter(vocabulary))


def count_tokens(
    docs: DataFrame,
    text_col: str = "text",
    carry: Sequence[str] = ("doc_id",),
    model: str = MODEL,
) -> DataFrame:
    """Number of unigram tokens of every whole text and the score of its best path.

    Only counts and scores are kept, never tokens. An unknown character counts
    as its UTF-8 bytes. Null texts have null results, empty ones no tokens.
    Returns the ``carry`` columns, ``n_tokens`` and ``score``.
    """
    shared = docs.sparkSession.sparkContext.broadcast(load_vocabulary(model))
    rows = docs.select(F.struct(*carry).alias("_row"), F.col(text_col).alias("_text"))
    schema = StructType(
        [
            rows.schema["_row"],
            StructField("n_tokens", LongType()),
            StructField("score", DoubleType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(shared.value)
        for batch in batches:
            found = [
                (None, None) if text is None else counter.count(text)
                for text in batch.column("_text").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_row"),
                    pa.array([n for n, _ in found], pa.int64()),
                    pa.array([s for _, s in found], pa.float64()),
                ],
                schema.names,
            )

    return carried(rows.mapInArrow(run, schema), "n_tokens", "score")


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token count and best score of every document."""
    return count_tokens(table(spark, sf_dir, "documents"))
