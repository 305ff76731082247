"""Benchmark hits against a search word by word."""

import re

import pytest

from saleswright.llm.decontaminate import contamination, merge_ranges

ITEMS = [
    (1, "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen"),
    (2, "Short ITEM here"),
    (3, None),
    (4, "... !!"),
    (None, "nameless words stand here"),
    (10, "ünï cödé wörds"),
    (10, "second text of ten"),
    (5, "here"),
]
WINDOW = " ".join("one two three four five six seven eight nine ten eleven twelve thirteen".split())
TEXTS = [
    f"Before, {WINDOW.upper()}! after",
    "one two three four five six seven eight nine ten eleven twelve",
    "x short--item\there y",
    None,
    "",
    "???",
    "nameless words stand here",
    "Ünï cödé wörds",
    "ünï CöDé wörds " + "filler " * 100,
    f"{WINDOW} fourteen fifteen {WINDOW} fourteen",
    "second text of ten here here",
    "here " * 5000,
]


def words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [(m.group(), *m.span()) for m in re.finditer(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)]


def by_hand(text, items):
    own = words(text)
    plain = [w for w, _, _ in own]
    hit, met = set(), set()
    for item_id, item in items:
        w = [x for x, _, _ in words(item)]
        size = min(13, len(w))
        for at in range(len(w) - size + 1 if w else 0):
            for i in range(len(plain) - size + 1):
                if plain[i : i + size] == w[at : at + size]:
                    hit |= set(range(i, i + size))
                    met.add(item_id)
    met.discard(None)
    covered = {c for i in hit for c in range(own[i][1], own[i][2])}
    return len(own), len(hit), sorted(map(str, met)), covered


@pytest.mark.parametrize("automaton_bytes", [1 << 20, 60])
def test_hits(spark, docs, automaton_bytes):
    benchmark = spark.createDataFrame(ITEMS, "item_id long, text string")
    found = contamination(docs(TEXTS), benchmark, automaton_bytes=automaton_bytes).collect()
    assert len(found) == len(TEXTS)
    for row in found:
        text = TEXTS[row.doc_id]
        n, hit, met, covered = by_hand(text, ITEMS)
        assert (row.n_words, row.n_hit, row.item_ids, row.n_items) == (n, hit, met, len(met))
        assert row.contaminated == (hit > 0 and 20 * hit >= n)
        inside = {c for s in row.spans for c in range(s.start, s.end)}
        assert covered <= inside
        for span in row.spans:
            assert span.start in covered and span.end - 1 in covered


def test_empty_tables(spark, docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert not any(r.n_hit for r in contamination(docs(TEXTS), none).collect())
    assert contamination(docs([]), none).count() == 0


def test_ranges():
    assert merge_ranges([(5, 8), (1, 3), (3, 4), (7, 9)]) == [(1, 4), (5, 9)]
