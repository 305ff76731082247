"""What all operators share: odd columns, registered queries, the pipeline."""

import os
from collections import Counter

import compare
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
import corpus_pipeline
from saleswright.llm import (
    decontaminate,
    exact_dedup,
    langid,
    lm,
    quality,
    queries,
    repeats,
    simhash,
    token_counts,
    unigram,
)

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
needs_data = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


def with_benchmark(spark):
    return spark.createDataFrame([(1, "some words"), (None, None)], "item_id long, text string")


def with_labels(spark):
    return spark.createDataFrame([(0, 1), (1, 0), (None, None)], "doc_id long, quality int")


OPERATORS = {
    "contamination": lambda s, d, c: decontaminate.contamination(d, with_benchmark(s), carry=c),
    "encode": lambda s, d, c: unigram.encode(d, carry=c),
    "repeats": lambda s, d, c: repeats.repeats(d, carry=c),
    "exact": lambda s, d, c: exact_dedup.exact_groups(d, carry=c),
    "language": lambda s, d, c: langid.predict_language(d, F.lit(True), carry=c),
    "quality": lambda s, d, c: quality.quality_scores(d, with_labels(s), F.lit(True), carry=c),
    "counts": lambda s, d, c: token_counts.count_tokens(d, carry=c),
    "lm": lambda s, d, c: lm.lm_scores(d, F.lit(True), carry=c),
    "near": lambda s, d, c: simhash.near_groups(d, carry=c),
}
CLASHING = ("score", "kept", "Fp", "tid", "_row", "_text", "_id", "n_tokens", "spans", "n", "key", "a.b")


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_clashing_columns(spark, docs, name):
    table = docs([(1, "some words"), (1, "some words"), (None, None), (2, "")])
    for column in CLASHING:
        table = table.withColumn(column, F.lit("mine"))
    carry = ["doc_id", "text", "lang", *[c for c in CLASHING if "." not in c]]
    found = OPERATORS[name](spark, table, carry)
    assert len({c.lower() for c in found.columns}) == len(found.columns)
    assert found.count() == 4
    assert Counter(r.doc_id for r in found.collect()) == Counter([1, 1, None, 2])


def test_registered():
    names = entry_points.queries()
    assert [n for n in names if n.startswith("op")] == list(queries.all_queries())
    assert "pipeline" in names and set(queries.oracle_queries()) <= set(names)


@needs_data
@pytest.mark.parametrize("name", sorted(queries.oracle_queries()))
def test_query_equals_its_sql(spark, name):
    duck = compare.open_duckdb(SF_DIR)
    mine = compare.spark_rows(queries.all_queries()[name](spark, SF_DIR))
    assert mine == compare.duckdb_rows(duck, queries.oracle_queries()[name])


@needs_data
def test_pipeline_stages(spark):
    """Every stage keeps what brute force over the stage's own input keeps."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    items = [r.text for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    before = {r.doc_id: r for r in docs.collect()}
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_DIR)
        if name != "pieces":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
            docs = spark.createDataFrame(docs.collect(), docs.schema)
        kept[name] = {r.doc_id: r for r in docs.collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    good = [k for k, q in labels.items() if q == 1 and k in before]
    bad = [k for k, q in labels.items() if q == 0 and k in before]
    assert sum(k in kept["quality"] for k in good) > 0.95 * len(good)
    assert sum(k in kept["quality"] for k in bad) < 0.2 * len(bad) + 1

    largest = {}
    for k, r in kept["quality"].items():
        largest[r.text or ""] = max(k, largest.get(r.text or "", k))
    assert set(kept["exact_dedup"]) == set(largest.values())

    prints = {k: simhash.fingerprint((r.text or "").encode()) for k, r in kept["exact_dedup"].items()}
    root = {k: k for k in prints}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in prints:
        for b in prints:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= 4:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    assert set(kept["near_dedup"]) == {find(k) for k in prints}

    matcher = decontaminate.Matcher([(str(k), t.encode()) for k, t in enumerate(items)])
    clean = set()
    for k, r in kept["near_dedup"].items():
        n, ranges, _, _ = matcher.scan((r.text or "").encode())
        hit = sum(b - a for a, b in ranges)
        if not (hit and 20 * hit >= n):
            clean.add(k)
    assert set(kept["decontamination"]) == clean
    assert set(kept["pieces"]) == clean
    assert all(r.round_trip for r in kept["pieces"].values())
    assert {r.doc_id for r in corpus_pipeline.run(spark, SF_DIR).collect()} == clean


STAGE_ROWS = [
    (1, "some plain words of a text"), (1, "some plain words of a text"), (None, "some plain words of a text"),
    (None, None), (2, None), (3, ""), (3, ""), (None, "own words of the row without an id"),
    (4, "word " * 200_000), (5, "of the house and the garden by the river"), (6, "last"),
]


@pytest.mark.parametrize("from_files", [True, False])
def test_stages_with_odd_rows(spark, docs, tmp_path, from_files):
    """Null ids, null and long texts, repeated rows and columns of the stages' own names."""
    clashing = ("_doc", "_place", "score", "kept", "file", "row", "stays")
    table = docs(STAGE_ROWS).withColumns({c: F.lit("mine") for c in clashing})
    with_labels(spark).write.parquet(f"{tmp_path}/labels.parquet")
    with_benchmark(spark).write.parquet(f"{tmp_path}/benchmark.parquet")
    if from_files:
        table.write.parquet(f"{tmp_path}/documents.parquet")
        table = spark.read.parquet(f"{tmp_path}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    found = {name: stages[name](spark, table, str(tmp_path)) for name in stages}
    for name, df in found.items():
        if name != "pieces":
            assert df.columns == table.columns
            assert all(r._doc == r.kept == r.row == "mine" for r in df.collect())
    by_text = {(text or ""): [] for _, text in STAGE_ROWS}
    for doc_id, text in STAGE_ROWS:
        by_text[text or ""].append(doc_id)
    largest = {t: max((i for i in ids if i is not None), default=None) for t, ids in by_text.items()}
    assert Counter((r.doc_id, r.text or "") for r in found["exact_dedup"].collect()) == Counter(
        (i, t) for t, i in largest.items()
    )
    near = found["near_dedup"].collect()
    assert len(near) == len({simhash.fingerprint((t or "").encode()) for t in by_text})
    assert found["decontamination"].count() == len(STAGE_ROWS)
    assert found["quality"].count() <= len(STAGE_ROWS)
    assert found["pieces"].count() == len(STAGE_ROWS)


def test_pipeline_of_nothing(spark, docs, tmp_path):
    docs([]).write.parquet(f"{tmp_path}/documents.parquet")
    with_labels(spark).limit(0).write.parquet(f"{tmp_path}/labels.parquet")
    with_benchmark(spark).limit(0).write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
