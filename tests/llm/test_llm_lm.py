"""Language model: every word and every token counts, whatever the sizes."""

from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from saleswright.llm import attention, lm
from saleswright.llm.common import text_bytes
from saleswright.session import temporary_conf


def test_scores_do_not_depend_on_hot_words(docs, monkeypatch):
    """Counts that are joined give the score that broadcast ones give."""
    monkeypatch.setattr(lm, "LEAST_STEPS", 5)
    texts = ["the cat sat on the mat", "the dog sat", None, "", "unseen words the " + "q" * 3000, "a cat a dog a mat"] * 2
    table = docs([(k, t) for k, t in enumerate(texts)])
    found = []
    for hot in (1 << 20, 2):
        monkeypatch.setattr(lm, "HOT_WORDS", hot)
        found.append({r.doc_id: r for r in lm.lm_scores(table, F.col("doc_id") != 4).collect()})
    assert len(found[0]) == len(found[1]) == len(texts)
    for k, row in found[0].items():
        assert found[1][k].score == pytest.approx(row.score, rel=1e-5)
        assert found[1][k].n_known == row.n_known


def test_all_of_a_text_is_trained_on(spark, docs):
    """Every id of every text, and its end, is once the target of a window."""
    texts = ["word " * 3000 + "last", "short text", "", "another long text " * 700]
    ranks = spark.sparkContext.broadcast(lm.load_ranks(lm.RANKS))
    train = docs(texts).select(text_bytes("text").alias("text"))
    rows = lm._gather(train, ranks).collect()
    targets = Counter()
    for r in rows:
        if r.kind == lm.SAMPLE:
            targets.update(np.frombuffer(r.ids, "<i4")[1:].tolist())
    counts = Counter()
    for r in rows:
        if r.kind == lm.ID:
            counts[r.key] += r.n
    assert targets == counts
    assert len({r.key % lm.ROUNDS for r in rows if r.kind == lm.SAMPLE}) == lm.ROUNDS


def test_model_sees_twenty_tokens_back():
    """Cycles of 20 tokens are foretold after their first turn: 16 tokens do not show them."""
    rng = np.random.default_rng(5)
    train, held = (
        [np.tile(rng.integers(0, 64, 20), 8)[: lm.WINDOW + 1] for _ in range(n)] for n in (1600, 50)
    )
    classes = lm.make_classes(np.bincount(np.concatenate(train), minlength=64), np.ones(64, int))
    follow = np.tile(np.log(classes.frequency), (classes.n, 1)).astype(np.float32)
    flat = attention.start(classes.n)
    for number in range(lm.ROUNDS):
        rate = lm.RATE * (1 - number / lm.ROUNDS)
        flat = lm.train_windows(flat, follow, classes, [train], rate)[1]
    logs = lm.spelled(attention.unpack(flat, classes.n), follow, classes, held)[0]
    assert logs.mean() > -0.6 * np.log10(64)


def test_common_ids_are_classes_of_their_own():
    classes = lm.make_classes(np.arange(1000, 0, -1), np.arange(1000) % 2)
    assert len(set(classes.of[:240])) == 240


def test_held_out_score_beats_frequencies(docs):
    """On cycles of known words the model's score is above the frequencies' own."""
    rng = np.random.default_rng(6)
    words = "time year people way day man thing woman life child world school state family".split()
    rows = [(k, " ".join(np.tile(rng.choice(words, 20), 8))) for k in range(420)]
    found = lm.lm_scores(docs(rows), F.col("doc_id") < 400).filter("doc_id >= 400").collect()
    assert len(found) == 20
    assert sum(r.score for r in found) > 0.9 * sum(r.base_score for r in found)


def test_scores_do_not_depend_on_partitions(spark, docs, monkeypatch):
    """Windows are dealt to shards by what they are, several shards here."""
    monkeypatch.setattr(lm, "SHARD_WINDOWS", 8)
    rng = np.random.default_rng(7)
    words = [f"w{k}" for k in range(60)]
    rows = [(k, " ".join(rng.choice(words, 300))) for k in range(60)] + [(60, None), (61, "lone")]
    found = []
    for parts, shuffled in ((3, "4"), (11, "7")):
        with temporary_conf(spark, {"spark.sql.shuffle.partitions": shuffled}):
            scored = lm.lm_scores(docs(rows, parts), F.col("doc_id") % 5 > 0).collect()
        found.append({r.doc_id: (r.n_tokens, r.n_known, r.score) for r in scored})
    for k, (n, known, score) in found[0].items():
        assert found[1][k][:2] == (n, known)
        assert found[1][k][2] == pytest.approx(score, rel=1e-5)


def test_partial_blocks_count_with_their_targets():
    """The mean is over real targets; what stands in the padding changes nothing."""
    rng = np.random.default_rng(7)
    k = 9
    flat = attention.start(k).astype(np.float64)
    flat += rng.normal(0, 0.1, len(flat))
    follow = rng.normal(size=(k, k))
    classes, target = rng.integers(0, k, (2, 3, attention.BLOCK))
    first = np.array([1, 0, 1], bool)
    target[1, 5:] = target[2, 1:] = -1
    loss, grad = attention.gradient(flat, follow, classes, first, target)
    logits = attention.forward(attention.unpack(flat, k), follow, classes, first).logits
    logs = logits - np.log(np.exp(logits).sum(axis=2, keepdims=True))
    real = target >= 0
    assert loss == pytest.approx(-logs[real, target[real]].mean())
    other = classes.copy()
    other[1, 5:] = other[2, 1:] = 4
    again = attention.gradient(flat, follow, other, first, target)
    assert again[0] == pytest.approx(loss)
    assert np.allclose(again[1], grad, atol=1e-6)


@pytest.mark.parametrize("full", [0, 8])
def test_short_texts_and_ends_are_learned(full):
    """Texts of under a block are trained on, with full blocks beside them or without."""
    rng = np.random.default_rng(8)
    windows = [np.array([9, 6, 7, 9])] * 24 + [rng.integers(0, 6, lm.WINDOW + 1) for _ in range(full)]
    classes = lm.make_classes(np.bincount(np.concatenate(windows), minlength=10), np.ones(10, int))
    follow = np.tile(np.log(classes.frequency), (classes.n, 1)).astype(np.float32)
    flat = lm.train_windows(attention.start(classes.n), follow, classes, [windows], lm.RATE)[1]
    logs = lm.spelled(attention.unpack(flat, classes.n), follow, classes, [windows[0]])[0]
    assert logs.min() > np.log10(0.8)


def test_words_and_spellings_are_those_of_each_text():
    """Found by Arrow, and spelled many at a time, for odd bytes as well."""
    parts = [b"a", b"B", "é日".encode(), b" ", b"\t", b"\x0b", b"\x1c", b"\xff", b"\xe2\x80", b"\xc2\xa0", b"\n", b"'s", b"1.", "\u180e".encode()]
    rng = np.random.default_rng(10)
    texts = [b"".join(parts[k] for k in rng.integers(0, len(parts), n)) for n in rng.integers(0, 25, 2000)]
    texts += [b"", b" ", b"one"]
    subwords = lm.Subwords(lm.load_ranks(lm.RANKS))
    words = lm.words_in(pa.array(texts, pa.binary()))
    assert len(set(words.different)) == len(words.different)
    ids, ends, lengths = subwords.spell(words)
    at = 0
    for k, (text, own) in enumerate(zip(texts, np.split(ids, ends[:-1]), strict=True)):
        found = [words.different[i] for i in words.which[words.offsets[k] : words.offsets[k + 1]]]
        assert found == text.lower().split()
        alone = [subwords.encoding.encode_ordinary(" " + w.decode("utf-8", "replace")) for w in found]
        assert own.tolist() == [subwords.end, *[i for x in alone for i in x], subwords.end]
        assert lengths[at : at + len(found) + 1].tolist() == [*map(len, alone), 1]
        at += len(found) + 1


def test_a_token_needs_its_own_groups_classes_only():
    """Groups times classes in the target's group are probabilities over all classes."""
    rng = np.random.default_rng(11)
    k = 3 * attention.SIDE + 5
    p = attention.unpack(rng.normal(0, 0.3, len(attention.start(k))), k)
    follow = rng.normal(size=(k, k))
    classes, target = rng.integers(0, k, (2, 4, attention.BLOCK))
    x = attention.forward(p, follow, classes, np.array([1, 0, 0, 1], bool))
    assert np.allclose(np.exp(x.logits).sum(axis=2), 1)
    made = attention.heads(x, np.arange(target.size), target.ravel())
    assert made.own.shape == (target.size, attention.SIDE)
    assert np.allclose(made.logs, x.logits.reshape(-1, k)[made.at, target.ravel()[made.at]])
    zero = attention.forward(attention.unpack(attention.start(k), k), follow, classes, np.ones(4, bool))
    plain = follow - np.log(np.exp(follow).sum(axis=1, keepdims=True))
    assert np.allclose(zero.logits, plain[classes], atol=1e-5)


def test_model_sees_twenty_words_back():
    """Cycles of 20 words of three ids each: 60 ids back, more than two blocks of ids hold."""
    rng = np.random.default_rng(12)
    opens = np.arange(74) < 64
    spelling = np.column_stack([np.arange(64), 64 + rng.integers(0, 10, (64, 2))])
    train, held = (
        [spelling[np.tile(rng.integers(0, 64, 20), 6)].ravel() for _ in range(n)] for n in (1600, 50)
    )
    classes = lm.make_classes(np.bincount(np.concatenate(train), minlength=74), opens.astype(int))
    follow = np.tile(np.log(classes.frequency), (classes.n, 1)).astype(np.float32)
    flat = attention.start(classes.words)
    for number in range(lm.ROUNDS):
        rate = lm.RATE * (1 - number / lm.ROUNDS)
        flat = lm.train_windows(flat, follow, classes, [train], rate)[1]
    logs, opening = lm.spelled(attention.unpack(flat, classes.words), follow, classes, held)
    first = np.concatenate([opens[ids[1:]] for ids in held])
    assert (logs - opening)[first].mean() > -0.6 * np.log10(64)


def test_all_ids_of_windows_are_trained_on(spark, docs):
    """Attention is given the classes of all ids, those inside words included."""
    ranks = spark.sparkContext.broadcast(lm.load_ranks(lm.RANKS))
    train = docs(["unforgettably xylophonic words", "zzqx " * 300, ""]).select(text_bytes("text").alias("text"))
    windows = lm._gather(train, ranks).filter(F.col("kind") == lm.SAMPLE)
    subwords = lm.Subwords(ranks.value)
    rng = np.random.default_rng(14)
    classes = lm.make_classes(rng.integers(0, 9, len(subwords.opens)), subwords.opens.astype(int))
    given = sorted((r.key, classes.of[np.frombuffer(r.ids, "<i4")].tolist()) for r in windows.collect())
    followed = lm._followed(windows, classes).filter("key IS NOT NULL").collect()
    assert sorted((r.key, np.frombuffer(r.ids, "<i2").tolist()) for r in followed) == given
    assert any(c >= classes.words for _, ids in given for c in ids)


def test_attention_foretells_ids_inside_words():
    """The last id of a word is its second one, and the two ids before it do not tell which."""
    rng = np.random.default_rng(15)

    def text(n):
        second = rng.integers(10, 20, n)
        return np.column_stack([rng.integers(0, 10, n), second, np.full((n, 2), 20), second]).ravel()

    train, held = [text(60) for _ in range(600)], [text(60) for _ in range(20)]
    opens = (np.arange(21) < 10).astype(int)
    classes = lm.make_classes(np.bincount(np.concatenate(train), minlength=21), opens)
    shape, w = lm.inside_shape(classes), classes.words
    total = np.zeros(np.prod(shape) + w * w, np.float32)
    lm.count_follows(total, np.concatenate(train), np.array([len(x) for x in train]), classes)
    counts, between = total[: np.prod(shape)].reshape(shape), total[np.prod(shape) :].reshape(w, w)
    follow = lm.follow_of(counts, between, classes)
    inside = lm.inside_of(follow, classes, counts)
    flat = lm.start(classes)
    for number in range(lm.ROUNDS):
        flat = lm.train_windows(flat, follow, classes, [train], lm.RATE * (1 - number / lm.ROUNDS))[1]
    by_words, by_ids = lm.both(flat, classes)
    p, by_ids = attention.unpack(by_words, w), attention.unpack(by_ids, classes.n)
    last = np.tile(np.arange(60 * 5) % 5 == 4, 20).reshape(20, -1)[:, 1:].ravel()
    logs, opening = lm.spelled(p, follow, classes, held, inside, by_ids)
    assert np.isfinite(logs).all() and np.isfinite(opening).all()
    assert logs[last].mean() > np.log10(0.4)
    assert lm.spelled(p, follow, classes, held, inside)[0][last].mean() < np.log10(0.2)
    some = [lm.spelled(p, follow, classes, [np.append(held[0][:33], i)], inside, by_ids) for i in range(21)]
    chances = np.array([10 ** logs[-1] for logs, _ in some])
    assert chances.sum() == pytest.approx(1, abs=1e-4)
    assert 10 ** some[0][1][-1] == pytest.approx(chances[:10].sum(), abs=1e-4)


def test_inside_words_the_two_ids_before_count():
    """Every target is counted once; what was counted gives probabilities over all ids."""
    rng = np.random.default_rng(13)
    classes = lm.make_classes(rng.integers(1, 50, 300), rng.integers(0, 2, 300))
    opening = np.flatnonzero(classes.opens[classes.of] > 0)
    windows = [np.append(rng.choice(opening), rng.integers(0, 300, n)) for n in (1, 7, 200, 400)]
    shape, w = lm.inside_shape(classes), classes.words
    total = np.zeros(np.prod(shape) + w * w, np.int32)
    words, numbers = lm.count_follows(total, np.concatenate(windows), np.array([len(x) for x in windows]), classes)
    counts, between = total[: np.prod(shape)].reshape(shape), total[np.prod(shape) :].reshape(w, w)
    expected, pairs = Counter(), Counter()
    for ids in windows:
        c = [classes.n, *classes.of[ids].tolist()]
        expected.update((a, b, x - w if x >= w else classes.n - w) for a, b, x in zip(c, c[1:], c[2:]))
        opened = [x for x in c[1:] if x < w]
        pairs.update(zip(opened, opened[1:]))
    assert {k: counts[k] for k in zip(*map(np.ndarray.tolist, np.nonzero(counts)))} == expected
    assert {k: between[k] for k in zip(*map(np.ndarray.tolist, np.nonzero(between)))} == pairs
    assert [x.tolist() for x in np.split(words, np.cumsum(numbers)[:-1])] == [x.tolist() for x in lm.words_of(windows, classes)]
    follow = lm.follow_of(counts.astype(np.float32), between.astype(np.float32), classes)
    assert np.allclose(np.exp(follow).sum(axis=1), 1, atol=1e-5)
    inside = lm.inside_of(follow, classes, counts.astype(np.float32))
    p = attention.unpack(rng.normal(0, 0.3, len(attention.start(w))).astype(np.float32), w)
    before = windows[2][:20]
    last = [10 ** lm.spelled(p, follow, classes, [np.append(before, i)], inside)[0][-1] for i in range(300)]
    assert sum(last) == pytest.approx(1, abs=1e-4)
    assert lm.spelled(p, follow, classes, [windows[2][:30]], inside)[0][:20] == pytest.approx(
        lm.spelled(p, follow, classes, [windows[2][:21]], inside)[0], abs=1e-4
    )
