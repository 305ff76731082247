"""Repeated byte strings against a count of all windows."""

import random
from collections import Counter
from hashlib import sha256

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from saleswright.llm import repeats as module
from saleswright.llm.repeats import LENGTH, contexts, first_least, pieces, repeated_spans, repeats
from saleswright.llm.run_index import build, suffix_array


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 2), min_size=1, max_size=60), st.integers(1, 4))
def test_index_matches_all_pairs(symbols, times):
    text = np.array(symbols * times)
    n = len(text)
    suffixes = [tuple(text[i:]) for i in range(n)]
    assert suffix_array(text).tolist() == sorted(range(n), key=suffixes.__getitem__)

    def common(a, b):
        k = 0
        while k < min(len(a), len(b)) and a[k] == b[k]:
            k += 1
        return k

    longest = [
        max([common(suffixes[i], suffixes[j]) for j in range(n) if j != i], default=0)
        for i in range(n)
    ]
    index = build(text)
    assert index.matching_lengths().tolist() == longest
    assert index.lengths.sum() == n


def test_a_repetitive_text_has_few_runs():
    base = np.random.default_rng(1).integers(0, 200, 500)
    assert len(build(np.tile(base, 20)).symbols) < 600


def test_first_least():
    h = np.random.default_rng(1).integers(0, 5, 300).astype(np.uint64)
    for width in (1, 2, 3, 7, 8, 13):
        expected = [i + int(np.argmin(h[i : i + width])) for i in range(300 - width + 1)]
        assert first_least(h, width).tolist() == expected


def test_contexts_hold_every_window_once():
    rng = random.Random(1)
    texts = [bytes(rng.choices(b"abc", k=n)) for n in (0, 199, 200, 900)] + [b"ab" * 400]
    windows = Counter()
    for group in pieces(texts):
        for number, place, size, _, _ in zip(*contexts(group)):
            windows.update((number, place + k) for k in range(size - LENGTH + 1))
    expected = {(k, i) for k, t in enumerate(texts) for i in range(len(t) - LENGTH + 1)}
    assert set(windows) == expected and set(windows.values()) == {1}


def planted():
    rng = random.Random(5)

    def text(n):
        return "".join(rng.choices("abcdefghij klmnop", k=n))

    passage, line = text(450), text(230)
    texts = [text(700) for _ in range(6)]
    texts += [text(150) + passage + text(90) for _ in range(4)]
    texts += [text(rng.randrange(100)) + line + text(60) for _ in range(5)]
    texts += [passage[:199] + text(40), passage[100:300], passage[100:299], "é" * 120 + text(80)]
    texts += [texts[0], texts[0], texts[1][:400] + "#" + texts[1][400:]]
    texts += ["ab" * 300, "z" * 201, "z" * 200, "q" * 200, "", None, text(199), line + line]
    long = text(600_000)
    return [*texts, long, long[523_000:525_500] + text(30)]


def by_hand(texts):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + LENGTH] for d in data for i in range(len(d) - LENGTH + 1))
    found = []
    for d in data:
        marked = np.zeros(len(d) + 2, np.int64)
        for i in range(len(d) - LENGTH + 1):
            if seen[d[i : i + LENGTH]] > 1:
                marked[i + 1 : i + 1 + LENGTH] = 1
        edges = np.diff(marked)
        runs = list(zip(np.flatnonzero(edges == 1).tolist(), np.flatnonzero(edges == -1).tolist()))
        keep = np.frombuffer(d, np.uint8)[marked[1:-1] == 0].tobytes()
        found.append((len(d), sum(b - a for a, b in runs), runs, sha256(keep).hexdigest()))
    return found


@pytest.mark.parametrize(("contexts_bound", "rows_bound"), [(2000, 500_000), (1, 0)])
def test_removal(docs, monkeypatch, contexts_bound, rows_bound):
    monkeypatch.setattr(module, "ANCHOR_CONTEXTS", contexts_bound)
    monkeypatch.setattr(module, "BROADCAST_ROWS", rows_bound)
    texts = planted()
    rows = repeats(docs(texts)).collect()
    assert len(rows) == len(texts)
    for (n, removed, runs, kept), row in zip(by_hand(texts), sorted(rows, key=lambda r: r.doc_id)):
        assert (row.n_bytes, row.n_removed, row.n_spans, row.kept_sha256) == (n, removed, len(runs), kept)
        assert [(x.lo, x.hi) for x in row.removed] == runs


def test_no_repeats(docs):
    assert [r.n_removed for r in repeats(docs(["abc" * 30, None])).collect()] == [0, 0]
    assert repeats(docs([])).count() == 0
    assert repeated_spans([b"a" * 150, b"a" * 150]) == [[], []]
