"""From raw documents to encoded training text, in five stages.

Each stage takes what the stage before kept and returns the columns of
``documents``; the last returns pieces. ``run`` writes every stage's result to
the shared folder, so a lost executor costs one stage at most.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from saleswright.llm.common import BROADCAST_ROWS, ship, table  # noqa: E402
from saleswright.llm.decontaminate import contamination  # noqa: E402
from saleswright.llm.exact_dedup import exact_groups  # noqa: E402
from saleswright.llm.quality import KEEP_SCORE, held_out, quality_scores  # noqa: E402
from saleswright.llm.simhash import near_groups  # noqa: E402
from saleswright.llm.unigram import encode  # noqa: E402
from saleswright.storage import drop, materialize, scratch_path, scratch_run  # noqa: E402

#: Learned models are part of the stages, so no SQL gives the same rows.
ORACLE_SQL = None

_DOC = ("_doc",)
_PLACE = ("_place",)
#: Rows that a Python worker is handed at a time. Whole rows go along with their
#: texts here, so Spark's 10,000 would be many megabytes, several times over.
_BATCH_ROWS = "1000"


def _ready(spark: SparkSession) -> None:
    """Prepare a session for Python workers that see whole documents."""
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", _BATCH_ROWS)


def _packed(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Id and text, with whole rows in ``_doc``."""
    _ready(spark)
    return docs.select("doc_id", "text", F.struct(*docs.columns).alias("_doc"))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that score below ``KEEP_SCORE``.

    Null and empty texts are scored like any other; repeated rows get equal
    scores and stay or go together. Columns of any name are handed through.
    """
    rows = _packed(spark, docs)
    found = quality_scores(rows, table(spark, sf_dir, "labels"), ~held_out(), carry=_DOC)
    return found.filter(F.col("score") >= KEEP_SCORE).select("_doc.*")


def _placed(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The documents, and id and text with the place of each row in its file.

    A place names a row for as long as the files stay, whatever its id, and is
    all that has to travel to tell which rows go. Documents that are not read
    from files are written first.
    """
    place = F.struct(
        F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")
    )
    try:
        placed = docs.select("doc_id", "text", place.alias("_place"))
    except AnalysisException:
        docs = materialize(docs, "documents")
        placed = docs.select("doc_id", "text", place.alias("_place"))
    return docs, placed


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """The documents whose places are not among those ``gone``.

    Up to ``BROADCAST_ROWS`` places are broadcast, 16 bytes each, and no text
    moves. More are joined by place, which moves every text once.
    """
    gone = materialize(gone.select("_place.*"), "gone")
    few = gone.count() <= BROADCAST_ROWS
    columns = [F.col(f"`{c}`") for c in docs.columns]
    rows = docs.select(
        F.struct(*columns).alias("_doc"),
        F.xxhash64("_metadata.file_path").alias("file"),
        F.col("_metadata.row_index").alias("row"),
    )
    left = rows.join(F.broadcast(gone) if few else gone, ["file", "row"], "left_anti")
    return left.select("_doc.*")


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each text, that with the largest id.

    Null counts as an empty text. Of rows that repeat an id and a text one
    stays; a null id is below all others. Columns of any name stay as they are.
    """
    _ready(spark)
    docs, placed = _placed(docs)
    return _without(docs, exact_groups(placed, carry=_PLACE).filter("not kept"))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near copies, that with the smallest id.

    Texts without words, null among them, are near copies of each other. Of rows
    that repeat the smallest id one stays. Columns of any name stay as they are.
    """
    _ready(spark)
    docs, placed = _placed(docs)
    return _without(docs, near_groups(placed, carry=_PLACE).filter("not stays"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents of which benchmark passages make up too much.

    A null or empty text has no words and stays. Repeated rows stay or go
    together, and columns of any name are handed through.
    """
    found = contamination(_packed(spark, docs), table(spark, sf_dir, "benchmark"), carry=_DOC)
    return found.filter(~F.col("contaminated")).select("_doc.*")


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encode every document and check that it decodes to its text."""
    _ready(spark)
    return encode(docs, carry=("doc_id", "lang", "source"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("exact_dedup", exact),
    ("near_dedup", near),
    ("decontamination", decontaminate),
    ("pieces", pieces),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``.

    What a stage wrote for itself goes when its result is written, and a
    stage's input when the next one has its own. The last result reads the
    table of the stage before it, so that one stays.
    """
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"stage-{name}")
        with scratch_run(spark):
            found = stage(spark, docs, sf_dir)
            found.write.parquet(path)
        docs = spark.read.schema(found.schema).parquet(path)
        if before is not None:
            drop(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """The pipeline as a registered query."""
    return {"pipeline": run}


def oracle_queries() -> dict[str, str]:
    """No SQL: see ``ORACLE_SQL``."""
    return {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
