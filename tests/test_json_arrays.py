"""JSON arrays read by byte ranges against Spark's reader of whole files."""

import json
import random
from collections import Counter

import pytest
from pyspark.sql import types as T

from saleswright.functions import dates
from saleswright.operators.ingest import add_ingestion_metadata
from saleswright.session import temporary_conf
from saleswright.sources.files import read_customers_json
from saleswright.sources.json_arrays import read_elements, read_json_arrays

SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("t", T.StringType()),
        T.StructField(
            "n",
            T.StructType(
                [
                    T.StructField("a", T.ArrayType(T.StringType())),
                    T.StructField("b", T.StringType()),
                    T.StructField("c", T.StructType([T.StructField("d", T.IntegerType())])),
                ]
            ),
        ),
    ]
)
TEXTS = ['a"b', "\\", '\\"', "x}{][,", "é ", "", 'q\\\\"}', None, "],[", '"},{"', "long " * 60]


def documents(n):
    rng = random.Random(n)
    return [
        {"id": str(k), "t": rng.choice(TEXTS), "n": {"a": rng.choices(TEXTS[:7], k=3), "b": "{", "c": {"d": k}}}
        for k in range(n)
    ]


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    folder = tmp_path_factory.mktemp("arrays")
    docs = documents(200)
    spaced = ",\n".join(json.dumps(x, ensure_ascii=False, indent=1) for x in docs[120:])
    (folder / "one-line.json").write_text(json.dumps(docs[:120]))
    (folder / "many-lines.json").write_text(f"\n [\n{spaced}\n]\n \n")
    (folder / "none.json").write_text(" [ ]\n")
    (folder / "empty.json").write_text("")
    (folder / "one.json").write_text('[{"id": "z"}]')
    (folder / "alone.json").write_text(json.dumps({**docs[3], "id": "alone"}, indent=1))
    (folder / "alone-too.json").write_text('{"id": "too", "t": "}{[", "n": {"a": ["x", "y"]}}\n\n')
    return str(folder)


def counted(df):
    return Counter(repr(tuple(r)) for r in df.collect())


@pytest.mark.parametrize("size", ["1000000", "3000", "211", "17"])
def test_ranges_of_any_size(spark, folder, size):
    conf = {"spark.sql.files.maxPartitionBytes": size, "spark.sql.files.openCostInBytes": "0"}
    if size == "17":
        # Thousands of ranges: one file is enough.
        folder = f"{folder}/one.json"
    with temporary_conf(spark, conf):
        mine = counted(read_json_arrays(spark, folder, SCHEMA))
    assert mine == counted(spark.read.schema(SCHEMA).option("multiLine", True).json(folder))


def test_one_file_is_read_by_many_tasks(spark, folder):
    with temporary_conf(spark, {"spark.sql.files.maxPartitionBytes": "3000", "spark.sql.files.openCostInBytes": "0"}):
        elements = read_elements(spark, f"{folder}/one-line.json")
        assert elements.count() == 120
        assert elements.rdd.getNumPartitions() > 5


def test_file_names(spark, folder):
    found = read_customers_json(spark, f"{folder}/one*.json", SCHEMA, file_column="source_file")
    stamped = add_ingestion_metadata(found, dates.time_value("2024-01-01"))
    assert stamped.columns == [*SCHEMA.names, "ingestion_timestamp", "source_file"]
    assert Counter(r.source_file for r in stamped.collect()) == {"one-line.json": 120, "one.json": 1}


def test_unreadable_element(spark, tmp_path):
    (tmp_path / "x.json").write_text('[{"id": "1"}, {"id": nonsense}, {"id": "3"}]')
    assert sorted(str(r.id) for r in read_json_arrays(spark, str(tmp_path), SCHEMA).collect()) == ["1", "3", "None"]
