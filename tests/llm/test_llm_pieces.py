"""Unigram encoding and counting against all segmentations."""

import functools
from hashlib import sha256

import numpy as np
import pytest

from saleswright.llm.pieces import Vocabulary, load_vocabulary, units
from saleswright.llm.token_counts import Counter, count_tokens
from saleswright.llm.unigram import MODEL, DoubleArray, Encoder, encode

WORDS = ["▁", "▁a", "a", "b", "ab", "ba", "aba", "▁ab", "▁▁", "c", "bc", "é", "▁é"]


@pytest.fixture(scope="module")
def tiny():
    pieces = [f"<0x{b:02X}>" for b in range(256)] + WORDS
    scores = [0.0] * 256 + [-3.0, -2, -2, -2, -4, -3, -6, -4, -5, -1, -3, -2, -5]
    usable = [False] * 256 + [True] * len(WORDS)
    return Vocabulary(tuple(pieces), tuple(scores), tuple(usable), tuple(range(256)), -16.0, "tiny")


def best_of_all(vocabulary, text):
    """Best score over every segmentation; of equal ones, pieces that start first, from the end."""
    score_of = {p: (s, i) for i, (p, s, ok) in enumerate(zip(vocabulary.pieces, vocabulary.scores, vocabulary.usable)) if ok}

    @functools.cache
    def best(end):
        if end == 0:
            return 0.0, ()
        found = None
        for start in range(end):
            part = text[start:end]
            if part in score_of:
                score, ids = score_of[part][0], (score_of[part][1],)
            elif end - start == 1:
                score, ids = vocabulary.unknown_score, tuple(part.encode())
            else:
                continue
            total = best(start)[0] + score
            if found is None or total > found[0]:
                found = total, best(start)[1] + ids
        return found

    return best(len(text))


TEXTS = ["a", "ab aba", "  ab  b", "abab abcba", "xyz é", "日本", "a b", "ba ", " ", "é" * 7, "abcabc" * 9]


@pytest.mark.parametrize("text", TEXTS)
def test_best_path(tiny, text):
    score, ids = best_of_all(tiny, "▁" + text.replace(" ", "▁"))
    encoder = Encoder(tiny)
    found = encoder.encode(text)
    assert found.tolist() == list(ids)
    assert encoder.score_of[found].sum() == score
    assert Counter(tiny).count(text) == (len(ids), score)
    assert encoder.decode(found) == text


def test_every_piece_is_in_the_trie():
    keys = [(p.encode(), k) for k, p in enumerate(WORDS)]
    trie = DoubleArray(keys)
    for key, number in keys:
        node = 0
        for b in key:
            child = trie.base[node] + b + 1
            assert trie.check[child] == node
            node = child
        assert trie.value[node] == number


def test_real_vocabulary_agrees_with_all_segmentations():
    vocabulary = load_vocabulary(MODEL)
    encoder, counter = Encoder(vocabulary), Counter(vocabulary)
    for text in ["the tions", "Größe", "ouen, the", "a\nb", "  indent", "naïve café", "%%%!!"]:
        score, ids = best_of_all(vocabulary, "▁" + text.replace(" ", "▁"))
        ids = [vocabulary.byte_ids[i] if i < 256 and vocabulary.pieces[i] != vocabulary.pieces[i] else i for i in ids]
        found = encoder.encode(text).tolist()
        assert sum(encoder.score_of[found]) == score
        assert counter.count(text) == (len(found), score)
        assert encoder.decode(np.array(found)) == text


def test_units_are_the_whole_text():
    for text in [*TEXTS, "a  b", " a", "a "]:
        assert "".join(" " + u for u in units(text, True)) == " " + text
    assert units("", True) == []


def test_tables(docs):
    texts = [*TEXTS, None, "", "dup", "dup", "with ▁ marker", "long " * 40_000]
    table = docs(texts)
    found = {r.doc_id: r for r in encode(table).collect()}
    counts = {r.doc_id: r for r in count_tokens(table).collect()}
    assert len(found) == len(counts) == len(texts)
    for k, text in enumerate(texts):
        row = found[k]
        assert row.n_pieces == counts[k].n_tokens
        if text is None:
            assert row.piece_ids is None and row.round_trip is None and row.score is None
        else:
            assert len(row.piece_ids) == row.n_pieces and row.score == counts[k].score
            assert row.round_trip == ("▁" not in text)
            decoded = text.replace("▁", " ")
            assert row.decoded_sha256 == sha256(decoded.encode()).hexdigest()
    assert found[texts.index("")].n_pieces == 0
