"""The conversation trie against plain prefix sets."""

import random
import re
import zlib
from collections import defaultdict
from hashlib import sha256

import numpy as np
import pytest

from saleswright.llm import conversation_trie as trie
from saleswright.session import temporary_conf

SCHEMA = "conv_id long, turn long, role string, text string, words string, family string, `Path` string"
MANY = {
    "spark.sql.shuffle.partitions": "9",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def table(spark, rows):
    full = [(*row, "mine", "mine", "mine") for row in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(3)


def by_hand(rows):
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            convs[conv].append((turn is not None, turn or 0, role or "", text or ""))
    paths = {c: tuple(t[2:] for t in sorted(turns)) for c, turns in convs.items()}
    members = defaultdict(list)
    for conv, path in paths.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(conv)
    childless = {p for p in members if not any(q[:-1] == p for q in members if q)}
    found = set()
    for path, convs in members.items():
        below = [q for q in members if q[: len(path)] == path]
        words = [len(re.findall(r"[^\x20\x09-\x0D]+", q[-1][1])) if q else 0 for q in below]
        ends = sorted(c for c in convs if len(paths[c]) == len(path))
        found.add(
            (
                min(convs), len(path), min(members[path[:-1]]) if path else None, len(convs),
                sum(len(q) == len(path) + 1 for q in below), sum(q in childless for q in below),
                sum((len(members[q]) - 1) * w for q, w in zip(below, words)),
                sha256(",".join(map(str, ends)).encode()).hexdigest(),
            )
        )
    return found


def shown(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def talks(seed, n=120, longest=9):
    rng = random.Random(seed)
    rows = []
    for conv in range(n):
        for turn in range(rng.choice([1, 2, 3, 3, longest])):
            role = rng.choice(["user", None, "assistant"]) if rng.random() < 0.2 else "user"
            text = rng.choice(["a b", "c", "", None, "d  e\tf"]) if rng.random() < 0.5 else "same words"
            rows.append((conv, turn, role, text))
    return rows


@pytest.mark.parametrize("shard", [1 << 18, 16, 1])
@pytest.mark.parametrize("seed", [1, 2])
def test_trie(spark, shard, seed):
    rows = talks(seed)
    with temporary_conf(spark, MANY):
        found = shown(trie.prefix_trie(trie.sequences(table(spark, rows)), shard))
    assert found == by_hand(rows)


@pytest.mark.parametrize("shard", [1 << 18, 40])
def test_hot_conversation_and_turn(spark, shard):
    """A third of all are copies, a third begin alike, one is very long, some are prefixes."""
    rows = [(c, t, "user", f"copy {t}") for c in range(60) for t in range(3)]
    rows += [(c, t, "user", "hot start" if t == 0 else f"own {c} {t}") for c in range(60, 120) for t in range(2)]
    rows += [(500, t, "user", f"long {t}") for t in range(150)]
    rows += [(c, t, "user", f"copy {t}") for c in (601, 602) for t in range(c - 600)]
    rows += [(603, 0, "user", "x" * 300_000)]
    with temporary_conf(spark, MANY):
        found = shown(trie.prefix_trie(trie.sequences(table(spark, rows)), shard))
    assert found == by_hand(rows)


def test_heads_and_odd_rows(spark):
    """Turns of a base, absent bases, negative ids, null turns, repeated rows, no id."""
    rows = talks(3, 75) + [(-7, 1, "u", "t"), (-20, None, None, None), (-20, 1, "u", "t"), (-20, 1, "u", "t")]
    rows += [(203, 0, "u", "alone"), (203, None, "u", "first"), (None, 1, "u", "lost"), (None, None, None, None)]
    c = -7  # SQL's remainder takes the sign of the dividend, so the base of -7 is 0
    family = "conv_id - conv_id % 20"
    with temporary_conf(spark, MANY):
        turns = trie.sequences(table(spark, rows), family=trie.F.expr(family))
        found = shown(trie.prefix_trie(trie.share_heads(turns), 30))
    expected = by_hand_with_sql_bases(rows)
    assert c in {r[0] for r in expected} and found == expected


def by_hand_with_sql_bases(rows):
    """As by_hand, with bases as SQL's remainder gives them."""
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            named = f"{len(role or '')}:{role or ''}{text or ''}"
            convs[conv].append((turn is not None, turn or 0, sha256(named.encode()).hexdigest(), role or "", text or ""))
    paths = {c: [t[3:] for t in sorted(turns)] for c, turns in convs.items()}
    out = []
    for c, path in paths.items():
        base = c - int(np.fmod(c, 20))
        h = zlib.crc32(str(c).encode()) % 4
        rebuilt = paths.get(base, [])[:h] + path[h:]
        out += [(c, i, *t) for i, t in enumerate(rebuilt)] or [(c, 0, None, None)]
        assert rebuilt, "the fixture has no conversation without turns"
    return by_hand(out)


def test_turnless(spark):
    """Conversations that lose all their turns stay, at the root."""
    c = next(c for c in range(1021, 1040) if zlib.crc32(str(c).encode()) % 4 >= 1)
    rows = [(c, 0, "u", "gone")]
    turns = trie.sequences(table(spark, rows), family=trie.F.expr("conv_id - conv_id % 20"))
    found = shown(trie.prefix_trie(trie.share_heads(turns)))
    assert found == {(c, 0, None, 1, 0, 1, 0, sha256(str(c).encode()).hexdigest())}


def test_no_rows(spark):
    assert trie.prefix_trie(trie.sequences(table(spark, []))).count() == 0


def test_sorted_like_tuples():
    rng = np.random.default_rng(5)
    for _ in range(40):
        lens = rng.integers(0, 40, 30)
        ids = rng.integers(1, 3, (lens.sum(), 2)).astype(np.uint64)
        conv = rng.permutation(30)
        offs = np.r_[0, np.cumsum(lens)]
        paths = [tuple(map(tuple, ids[offs[i] : offs[i + 1]].tolist())) for i in range(30)]
        order, own = trie.sort_shard(conv, lens, ids)
        assert order.tolist() == sorted(range(30), key=lambda i: (paths[i], conv[i]))
        seen = set()
        for i in order.tolist():
            fresh = [d for d in range(1, lens[i] + 1) if paths[i][:d] not in seen]
            assert own[i] == (fresh[0] if fresh else lens[i] + 1)
            seen |= {paths[i][:d] for d in range(1, lens[i] + 1)}
