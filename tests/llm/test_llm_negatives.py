"""Hard negatives against plain loops, and the intervals against exact products."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from saleswright.llm import hard_negatives as hard

SCHEMA = "vec_id long, embedding array<double>, label int, score string, `search` string, _at string"


def table(spark, rows):
    return spark.createDataFrame([(*r, "mine", "mine", "mine") for r in rows], SCHEMA).repartition(5)


def by_hand(rows, every=10, positives=5, negatives=10):
    good = [
        (i, [math.floor(256 * x) for x in v], y)
        for i, v, y in rows
        if i is not None and y is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for a, (anchor, v, label) in enumerate(good):
        if anchor % every:
            continue
        scored = sorted(
            ((-sum(x * y for x, y in zip(v, w)), i, b, y) for b, (i, w, y) in enumerate(good) if b != a)
        )
        for s, i, _, _ in [r for r in scored if r[3] == label][:positives]:
            fits = [r for r in scored if r[3] != label and 30 * -s <= 100 * -r[0] <= 90 * -s]
            out += [(anchor, i, k + 1, r[1], -s, -r[0]) for k, r in enumerate(fits[:negatives])]
    return sorted(out)


def found(df, every=10, **options):
    return sorted(tuple(r) for r in hard.hard_negatives(df, F.col("vec_id") % every == 0, **options).collect())


def vectors(seed, n=400, dims=20, labels=4):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((labels, dims))
    labels_of = rng.integers(0, labels, n)
    rows = centres[labels_of] + rng.standard_normal((n, dims)) * 1.5
    return [(k, [float(x) for x in v], int(y)) for k, (v, y) in enumerate(zip(rows / 8, labels_of))]


ODD = [
    (1000, None, 1), (1010, [1.0, None], 1), (1020, [float("nan")], 1), (1030, [float("inf")], 1),
    (1040, [0.5], None), (None, [0.5], 1), (1050, [], 1), (1060, [0.25], 2), (1070, [-1.0] * 20, 0),
    (1080, [0.0] * 20, 3), (1090, [1.0] * 20, 9),
]


@pytest.mark.parametrize("seed", [1, 2])
def test_negatives(spark, seed):
    rows = vectors(seed) + ODD
    assert found(table(spark, rows)) == by_hand(rows)


def test_ties_and_repeated_rows(spark):
    """A third of all vectors are the same, and some rows come twice."""
    rows = vectors(3, 200)
    same = rows[0][1]
    rows += [(2000 + k, same, k % 3) for k in range(100)] + rows[:30]
    mine, plain = found(table(spark, rows)), by_hand(rows)
    assert mine == plain


def test_blocks(spark, monkeypatch):
    rows = vectors(4)
    monkeypatch.setattr(hard, "BLOCK_ANCHORS", 7)
    assert found(table(spark, rows), positives=3, negatives=4) == by_hand(rows, positives=3, negatives=4)


def test_nothing(spark):
    assert found(table(spark, [])) == []
    assert found(table(spark, [(1, [1.0], 1)])) == []
    assert found(table(spark, [(10, [1.0], 1)])) == []


@pytest.mark.parametrize("dims", [1, 5, 64, 130, 300])
@pytest.mark.parametrize("scale", [1, 300, 100_000])
def test_intervals_hold(dims, scale):
    rng = np.random.default_rng(dims)
    rows = np.rint(rng.standard_normal((300, dims)) * scale).astype(np.int64)
    rows[:3] = 0
    rows[3:6] = rows[6:9]
    queries = hard.Queries.of(rows[::7])
    exact = rows[::7] @ rows.T
    for levels in (1, 4):
        low, high = queries.intervals(hard.Codes.of(rows, levels))
        assert (low <= exact).all() and (exact <= high).all()
    narrow = (high - low).mean()
    length = np.sqrt((rows[::7] ** 2).sum(1))[:, None] * np.sqrt((rows**2).sum(1))
    assert narrow < length.mean() or dims == 1


def test_rotation_keeps_lengths():
    rows = np.random.default_rng(1).standard_normal((50, 300))
    assert np.allclose(np.sqrt((hard.rotate(rows) ** 2).sum(1)), np.sqrt((rows**2).sum(1)))
