"""The classifier's parts against their definitions and a solver of another kind."""

import random
import zlib
from math import log

import numpy as np
import pytest
from pyspark.sql import functions as F

from staywise.llm import nbsvm


def spread(value):
    return value % 2**32 * 2654435761 % 2**32 >> (32 - nbsvm.FEATURE_BITS)


def slow_features(text):
    found = {spread(text[i] << 16 | text[i + 1] << 8 | text[i + 2]) for i in range(len(text) - 2)}
    words = text.split()
    hashes = [zlib.crc32(w) for w in words]
    found |= {spread(h) for h in hashes}
    found |= {spread(a * 31 + b + 7) for a, b in zip(hashes, hashes[1:], strict=False)}
    for times in nbsvm.REPEATS:
        if any(len(set(words[i : i + times])) == 1 for i in range(len(words) - times + 1)):
            found.add(times)
    return sorted(found)


TEXTS = [
    b"", b"a", b"ab", b"abc", b" \t\n", b"one two two two three", "é日本 x x".encode(), b"w " * 9,
    b"long word " * 3000 + b"end", b"x" * 5000, b"a b\x00c a b",
]


@pytest.mark.parametrize("text", TEXTS)
def test_features_by_definition(text):
    assert nbsvm.features(text).tolist() == slow_features(text)


def test_ratios_by_definition():
    rows = [nbsvm.features(t) for t in TEXTS]
    labels = np.array([1, 0, 0, 1, 1, 0, 1, 0, 0, 1, 1])
    found = nbsvm.ratios(rows, labels)
    sets = [set(r.tolist()) for r in rows]
    for feature in {*range(8), *sets[5], *sets[8], *sets[10]}:
        share = [
            (1 + sum(feature in s for s, y in zip(sets, labels, strict=True) if y == label))
            / (2 + sum(labels == label))
            for label in (1, 0)
        ]
        assert found[feature] == pytest.approx(log(share[0] / share[1]), abs=1e-12)


def slow_fit(x, signs, limit):
    """The dual by projected gradient steps on the whole matrix; weights and bias."""
    wide = np.hstack([x, np.ones((len(x), 1))]) * signs[:, None]
    q = wide @ wide.T
    alpha, rate = np.zeros(len(x)), 1 / np.linalg.eigvalsh(q)[-1]
    for _ in range(60_000):
        alpha = np.clip(alpha + rate * (1 - q @ alpha), 0, limit)
    return wide.T @ alpha


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_descent_ends_where_another_solver_does(seed):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(24):
        label = int(i % 3 == 0)
        own = [rng.randrange(30) + 100 * (rng.random() < 0.8) * label for _ in range(8)]
        rows.append(np.array(sorted(set(own)), dtype=np.int32))
        labels.append(label)
    labels = np.array(labels)
    scale = np.random.default_rng(seed).normal(size=1 << nbsvm.FEATURE_BITS) + 1.5
    weights, bias = nbsvm.descend(rows, labels, scale, rounds=20_000, least_step=1e-10)
    usual = nbsvm.descend(rows, labels, scale)
    x = np.zeros((len(rows), 200))
    for i, row in enumerate(rows):
        x[i, row] = scale[row] / max(1.0, len(row) ** 0.5)
    share = [max(1, (labels == 0).sum()), max(1, (labels == 1).sum())]
    limit = np.array([len(labels) / (2 * share[y]) for y in labels])
    signs = np.where(labels == 1, 1.0, -1.0)
    best = slow_fit(x, signs, limit)

    def loss(w, b):
        hinge = np.maximum(0, 1 - signs * (x @ w + b))
        return (w @ w + b * b) / 2 + limit @ hinge

    own = weights[:200] / scale[:200]
    least = loss(best[:-1], best[-1])
    assert loss(own, bias) == pytest.approx(least, rel=1e-6)
    assert np.allclose(own, best[:-1], atol=1e-4) and bias == pytest.approx(best[-1], abs=1e-4)
    # The usual dozen rounds come near.
    assert least <= loss(usual[0][:200] / scale[:200], usual[1]) <= 1.05 * least


def test_fit_with_long_and_odd_texts(spark):
    """Labelled texts that are long, empty or null are features like any other."""
    rows = [(i, ("good words here " if i % 2 else "bad noise noise ") * (1 + i % 5)) for i in range(60)]
    rows += [(100, "good words here " * 40_000), (101, "bad noise noise " * 40_000), (102, ""), (103, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marked = [(i, i % 2) for i, _ in rows if i < 60] + [(100, 1), (101, 0), (102, 0), (103, 0)]
    labels = spark.createDataFrame(marked, "doc_id long, quality int")
    model = nbsvm.fit(docs, labels)
    found = {r.doc_id: r.predicted for r in nbsvm.classify(docs, model).collect()}
    assert len(found) == len(rows)
    assert [found[i] for i in range(60)] == [i % 2 for i in range(60)] and (found[100], found[101]) == (1, 0)
    # Rows with a null label or key, and keys marked both ways, teach nothing.
    noise = spark.createDataFrame([(None, 1), (1, None), (3, 0), (3, 1), (999, 1)], "doc_id long, quality int")
    again = nbsvm.fit(docs, labels.where("doc_id != 3").unionByName(noise.where("doc_id is null or doc_id = 999")))
    without = nbsvm.fit(docs, labels.where(F.col("doc_id") != 3).unionByName(noise))
    assert (again.weights == without.weights).all() and again.bias == without.bias
