"""Classifiers' arithmetic against plain loops over explicit sets, means and sums."""

import math
import random

import numpy as np
import pytest

from saleswright.llm import langid, quality

RNG = random.Random(8)
WORDS = "the der le il of und et di naïve größe élan 日本 cat katze chat gatto".split()


def text(words, n):
    return " ".join(RNG.choice(words) for _ in range(n)).encode()


def test_language_margins_equal_a_dense_kernel():
    """Presence kernel over explicit sets, its landmark root, and a plain ridge solve."""
    texts = [text(WORDS[k : k + 9], 4 + k) for k in range(7) for _ in range(6)]
    labels = ["xyz"[k % 3] for k in range(len(texts))]
    model = langid.fit(langid.presence_matrix(texts), labels)
    sets = [set(langid.presence(t).tolist()) for t in texts]

    def kernel(a, b):
        return len(a & b) / math.sqrt(len(a) * len(b))

    # With fewer texts than landmarks all of them are.
    assert len(texts) <= langid.LANDMARKS
    gram = np.array([[kernel(a, b) for b in sets] for a in sets])
    values, vectors = np.linalg.eigh(gram)
    good = values > 1e-6 * values.max()
    space = gram @ vectors[:, good] / np.sqrt(values[good])
    target = np.array([[1.0 if y == name else -1.0 for name in "xyz"] for y in labels])
    ones = np.ones((len(texts), 1))
    # The bias is not held down: solve for it together with the weights.
    both = np.hstack([space, ones])
    hold = langid.RIDGE * np.diag([1.0] * space.shape[1] + [0.0])
    plain = both @ np.linalg.solve(both.T @ both + hold, both.T @ target)
    assert model.margins(texts) == pytest.approx(plain, abs=2e-3)


@pytest.mark.parametrize("n", [0, 1, 2, 40])
def test_quality_score_is_the_softmax_of_a_mean(n):
    rng = np.random.default_rng(n)
    vectors = rng.standard_normal((quality.BUCKETS, 3))
    out = rng.standard_normal((3, 2))
    odds = rng.standard_normal(2)
    model = quality.QualityModel(vectors @ (out[:, 1] - out[:, 0]), float(odds[1] - odds[0]))
    data = text([*WORDS, "the"], n)
    found, before = [], None
    for word in data.split():
        found += quality.features(word)
        found += [quality._AGAIN] if word == before else []
        before = word
    mean = sum((vectors[b] for b in found), np.zeros(3)) / max(1, len(found))
    logits = mean @ out + odds
    softmax = math.exp(logits[1]) / (math.exp(logits[0]) + math.exp(logits[1]))
    assert quality.Scorer(model).score(data) == pytest.approx(softmax)


def test_quality_bags_are_shares_of_features():
    data = b"one two two three one"
    buckets, shares = quality.bag(data, {w: quality.features(w) for w in data.split()})
    found = [b for w in data.split() for b in quality.features(w)] + [quality._AGAIN]
    assert shares.sum() == pytest.approx(1)
    assert {b: found.count(b) / len(found) for b in found} == pytest.approx(dict(zip(buckets.tolist(), shares.tolist())))
