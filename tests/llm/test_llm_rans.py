"""Coding and decoding of ids, in memory and through files."""

import zlib
from dataclasses import replace

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from saleswright.llm import rans, token_files
from saleswright.llm.common import parts_of
from saleswright.llm.token_files import TOKENIZER, read_token_files, write_token_files


def coded(ids, lanes=rans.LANES):
    table = rans.make_table(ids)
    return rans.encode_block(ids, table, lanes), table


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 60_000), max_size=400), st.integers(1, 9))
def test_ids_survive(ids, lanes):
    ids = np.array(ids, np.uint32)
    block, table = coded(ids, lanes)
    assert int(table.freqs.sum()) == (1 << table.bits if len(ids) else 0)
    back = rans.decode_block(block, table, rans.symbol_of_slot(table))
    assert back.tolist() == ids.tolist()


@pytest.mark.parametrize(
    "ids",
    [
        np.zeros(5000, np.uint32),
        np.arange(50_257, dtype=np.uint32),
        np.random.default_rng(1).zipf(1.3, 70_000).clip(0, 50_000).astype(np.uint32),
    ],
    ids=["one symbol", "every symbol", "skewed"],
)
def test_extreme_distributions(ids):
    block, table = coded(ids, 64)
    assert (rans.decode_block(block, table, rans.symbol_of_slot(table)) == ids).all()


def test_spans_decode_on_their_own():
    ids = np.random.default_rng(2).integers(0, 90, 40_000).astype(np.uint32)
    block, table = coded(ids, 32)
    owner = rans.symbol_of_slot(table)
    assert len(block.places) > 3
    size = rans.CHECKPOINT_STEPS * 32
    for span in reversed(range(len(block.places))):
        found = rans.decode_span(block, table, owner, span)
        assert (found == ids[span * size : (span + 1) * size]).all()


def test_size_is_near_the_entropy():
    rng = np.random.default_rng(3)
    ids = rng.choice(64, 200_000, p=np.arange(1, 65) / 2080).astype(np.uint32)
    share = np.bincount(ids) / len(ids)
    entropy = -(share * np.log2(share)).sum() * len(ids) / 8
    assert len(coded(ids)[0].words) < 1.02 * entropy + 4 * rans.LANES


def test_damage_is_seen():
    block, table = coded(np.arange(3000, dtype=np.uint32) % 700, 32)
    words = bytearray(block.words)
    words[10] ^= 1
    with pytest.raises(rans.CorruptBlock):
        rans.decode_block(replace(block, words=bytes(words)), table, rans.symbol_of_slot(table))


def test_segments_hold_whole_documents(monkeypatch):
    monkeypatch.setattr(rans, "BLOCK_TOKENS", 10)
    monkeypatch.setattr(rans, "SEGMENT_TOKENS", 30)
    documents = [(k, np.zeros(n, np.uint32)) for k, n in enumerate([3, 4, 9, 100, 1, 1, 12, 5])]
    segments = list(token_files._segments(documents))
    assert [doc for s in segments for b in s for doc, _ in b] == list(range(8))
    assert max(len(b) for s in segments for b in s) <= 3 and len(segments) > 1


TEXTS = [
    "plain words, and more words.\nA second line",
    "",
    None,
    "  two  blanks \n\n and\ttabs ",
    " lead",
    "trail ",
    "\n",
    "naïve 日本語 🎉 text ᠎ x",
    "it's we'll 12 34a",
    "word " * 3000,
    "x" * 20_000,
    "a literal <|endoftext|> inside, and <|endoftext|>\n<|endoftext|> <|endoftext|>",
    "<|endoftext|>",
    "<|endoftext |>",
    "plain words, and more words.\nA second line",
]


def test_files_give_the_ids_of_whole_texts(spark, docs, tmp_path):
    write_token_files(docs([(None, "no id"), *[(50 - k, t) for k, t in enumerate(TEXTS)]]), f"{tmp_path}/t")
    found = {r.id: r for r in read_token_files(spark, f"{tmp_path}/t").collect()}
    whole = Tokenizer.from_file(TOKENIZER)
    place = 0
    for doc_id in sorted(found, key=lambda x: (x is not None, x)):
        text = "no id" if doc_id is None else TEXTS[50 - doc_id]
        ids = [*whole.encode(text or "", add_special_tokens=False).ids, 0]
        row = found[doc_id]
        assert (row.start, row.n_tokens) == (place, len(ids))
        assert row.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        place += len(ids)


def test_repeated_rows_and_ids_all_count(spark, docs, tmp_path):
    write_token_files(docs([(1, "same"), (1, "same"), (1, "other"), (2, None)]), f"{tmp_path}/t")
    found = read_token_files(spark, f"{tmp_path}/t").orderBy("start").collect()
    assert [r.id for r in found] == [1, 1, 1, 2]
    assert [r.start for r in found[1:]] == np.cumsum([r.n_tokens for r in found])[:3].tolist()


def test_no_documents(spark, docs, tmp_path):
    write_token_files(docs([]), f"{tmp_path}/t")
    assert read_token_files(spark, f"{tmp_path}/t").count() == 0


def test_each_different_unit_is_looked_up_once(monkeypatch):
    """What is done in Python follows the different units, and the ids are the library's."""
    from tokenizers import Tokenizer

    with open(TOKENIZER, encoding="utf-8") as file:
        definition = file.read()
    tokens, plain = token_files.Tokens(definition), Tokenizer.from_str(definition)
    looked = []
    ids = token_files._Units.ids
    monkeypatch.setattr(
        token_files._Units, "ids", lambda self, units: looked.append(list(units)) or ids(self, units)
    )
    letters = [*"ab1'.\n  \t \u180e\u00a0\u3000é日😀\x1c\x85", "ll", "word", "<|endoftext|>"]
    rng = np.random.default_rng(9)
    odd = ["".join(rng.choice(letters, rng.integers(0, 30))) for _ in range(3000)]
    texts = [*odd, "", " ", "\n", "a\n", " a", "a ", "the same words\nthe same words\n" * 500]
    for text, found in zip(texts, tokens.encode(texts), strict=True):
        assert plain.encode(text, add_special_tokens=False).ids == found.tolist()
    assert all(len(units) == len(set(units)) for units in looked)
    assert sum(map(len, looked)) < sum(len(t.split(" ")) for t in texts)


def test_parts_of_a_batch_are_bounded():
    rows = pa.table({"text": ["x" * 10, None, "y" * 25, "", "z" * 3, "w" * 4]}).to_batches()[0]
    parts = [p.column("text").to_pylist() for p in parts_of(rows, "text", 12)]
    assert [t for p in parts for t in p] == rows.column("text").to_pylist()
    assert all(sum(len(t or "") for t in p[:-1]) <= 12 for p in parts)
    assert list(parts_of(rows.slice(0, 0), "text", 12)) == []
