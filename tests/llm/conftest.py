import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

from saleswright.llm.common import ship

DOCS = StructType(
    [
        StructField("doc_id", LongType()),
        StructField("text", StringType()),
        StructField("lang", StringType()),
        StructField("source", StringType()),
        StructField("n_chars", LongType()),
    ]
)


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture
def docs(spark):
    """Documents from texts (ids count up) or (id, text[, lang]) rows."""

    def make(rows, parts=3):
        full = []
        for number, row in enumerate(rows):
            doc_id, text, lang = row if isinstance(row, tuple) and len(row) == 3 else (
                (*row, None) if isinstance(row, tuple) else (number, row, None)
            )
            full.append((doc_id, text, lang, None, None if text is None else len(text)))
        return spark.createDataFrame(full, DOCS).repartition(parts)

    return make
