"""Line bitmaps against plain counting."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from saleswright.llm.line_dedup import keep_lines, line_bitmaps, line_key
from saleswright.session import temporary_conf

MANY = {
    "spark.sql.shuffle.partitions": "7",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def kept_by_hand(rows, least_docs, keep_first, least_chars=1):
    docs = defaultdict(set)
    for number, (doc_id, text) in enumerate(rows):
        for line in (text or "").split("\n"):
            docs[line_key(line.encode())].add(number)
    common = {k for k, n in docs.items() if len(k.decode()) >= least_chars and len(n) >= least_docs}
    first = {}
    for k in common:
        ids = {rows[n][0] for n in docs[k]}
        least = None if None in ids else min(ids)
        texts = {rows[n][1] or "" for n in docs[k] if rows[n][0] == least}
        assert len(texts) == 1, "the fixture leaves the first document open"
        first[k] = least
    out = []
    for doc_id, text in rows:
        seen, kept = set(), []
        for line in (text or "").split("\n"):
            key = line_key(line.encode())
            if key in common and not (keep_first and first[key] == doc_id and key not in seen):
                seen.add(key)
                continue
            seen.add(key)
            kept.append(line)
        out.append((doc_id, text, len((text or "").split("\n")), "\n".join(kept)))
    return sorted(out, key=repr)


def found(docs, **options):
    with temporary_conf(docs.sparkSession, MANY):
        rows = line_bitmaps(docs, carry=("doc_id", "text"), **options).collect()
    out = []
    for r in rows:
        text = (r.text or "").encode()
        bits = np.unpackbits(np.frombuffer(zlib.decompress(r.keep_bits), np.uint8), bitorder="little")
        assert r.n_dropped == r.n_lines - bits[: r.n_lines].sum()
        assert r.n_dropped or keep_lines(text, r.keep_bits) == text
        out.append((r.doc_id, r.text, r.n_lines, keep_lines(text, r.keep_bits).decode()))
    return sorted(out, key=repr)


LINES = ["One line", "  one LINE\t", "Ä Ö", "ä ö", "", " \r", "x", "long " * 50, "zwölf", "no\x00thing"]


def texts(seed, n=150):
    rng = random.Random(seed)
    rows = [(k, "\n".join(rng.choice([*LINES, f"own {k} {rng.random()}"]) for _ in range(rng.randrange(1, 9)))) for k in range(n)]
    rows += [(1000, None), (1001, ""), (1002, "\n"), (1003, "last\n" * 30_000), (None, "one line\nnull id")]
    return rows + [(1004, "twice\ntwice\nx"), (1004, "twice\ntwice\nx")]


@pytest.mark.parametrize("keep_first", [False, True])
@pytest.mark.parametrize("least", [1, 2, 10, 60])
def test_lines(docs, keep_first, least):
    rows = texts(least)
    assert found(docs(rows), least_docs=least, keep_first=keep_first) == kept_by_hand(rows, least, keep_first)


def test_least_chars(docs):
    rows = texts(3)
    for chars in (2, 4):
        assert found(docs(rows), keep_first=False, least_chars=chars) == kept_by_hand(rows, 2, False, chars)


@pytest.mark.parametrize("keep_first", [False, True])
def test_hot_line(spark, keep_first):
    """Every document has one line, so its run goes over several partitions."""
    rows = spark.range(3000).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("Hot line \n"), F.col("id"), F.lit("\nhot line")).alias("text")
    )
    with temporary_conf(spark, MANY):
        out = line_bitmaps(rows, least_docs=10, keep_first=keep_first).collect()
    assert {(r.doc_id, r.n_dropped) for r in out} == {
        (i, 1 if keep_first and i == 0 else 2) for i in range(3000)
    }


def test_repeated_rows_keep_the_first_line(docs):
    rows = [(1, "a\nb"), (1, "a\nb"), (2, "b\nc"), (None, "c")]
    assert found(docs(rows)) == sorted(
        [(1, "a\nb", 2, "a\nb"), (1, "a\nb", 2, "a\nb"), (2, "b\nc", 2, ""), (None, "c", 1, "c")], key=repr
    )


def test_clashing_columns(docs):
    table = docs([(1, "a"), (2, "a\nb")])
    names = ["key", "n", "kind", "first", "n_lines", "keep_bits", "_id", "_row"]
    table = table.withColumns({c: F.lit("mine") for c in names})
    out = line_bitmaps(table, carry=["doc_id", *names]).collect()
    assert sorted((r.doc_id, r.key, r.n_lines, r.n_dropped) for r in out) == [(1, "mine", 1, 0), (2, "mine", 2, 1)]


def test_no_rows(docs):
    assert line_bitmaps(docs([])).count() == 0
