"""Top-k search and near-duplicate vectors against brute force."""

from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from staywise.llm import pivots, topk
from staywise.llm.components import components

SCHEMA = "vec_id bigint, embedding array<float>, label int, score double, list string"


def table(spark, rows):
    return spark.createDataFrame([(*row, 0.0, "x") for row in rows], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def odd_vectors(spark):
    """Ties, copies, clusters, zero, null and broken vectors, lengths that differ."""
    draw = np.random.default_rng(5)
    centres = draw.normal(size=(4, 8))
    rows = []
    for i in range(150):
        noise = draw.normal(size=8) * (0.05 if i % 3 else 0.4)
        rows.append((i, (centres[i % 4] + noise).tolist(), i % 2))
    rows += [(1000 + i, rows[7][1], 1) for i in range(6)]
    rows += [
        (None, rows[7][1], 1),
        (200, [0.0] * 8, 0),
        (201, None, 0),
        (202, [1.0, None] + [0.0] * 6, 0),
        (203, [float("nan")] * 8, 0),
        (204, [float("inf")] * 8, 0),
        (205, rows[3][1], None),
        (206, [1.0, 2.0], 0),
        (250, [1.0, 2.0], 0),
        (207, [], 0),
        (208, [3e30] * 8, 1),
    ]
    return table(spark, rows)


def sound(vector):
    return vector is not None and all(x is not None and np.isfinite(x) for x in vector)


@pytest.mark.parametrize("rows,queries", [(8192, 1024), (20, 3)])
def test_top_same_as_brute_force(odd_vectors, rows, queries):
    held = [(r.vec_id, r.embedding) for r in odd_vectors.collect()]
    held = [(i, [int(np.floor(256.0 * x)) for x in v]) for i, v in held if i is not None and sound(v)]
    expected = Counter()
    for q, w in held:
        if q % 50:
            continue
        scored = [
            (-min(sum(a * b for a, b in zip(w, v, strict=True)), (1 << 63) - 1), i)
            for i, v in held
            if i != q and len(v) == len(w)
        ]
        for rank, (s, i) in enumerate(sorted(scored)[:5], 1):
            expected[q, rank, i, -s] += 1
    found = topk.top(odd_vectors, F.col("vec_id") % 50 == 0, rows=rows, queries=queries)
    assert Counter(map(tuple, found.collect())) == expected


def test_top_stops_early():
    draw = np.random.default_rng(1)
    values = np.floor(draw.normal(size=(5000, 2)) * 1000)
    block = topk.Block(np.arange(5000), values)
    scored = []
    original = block._scores
    block._scores = lambda rows, query: scored.append(len(rows)) or original(rows, query)
    query = np.array([3.0, -2.0])
    best = block.best(-1, query, 5)
    exact = (values @ query).astype(int)
    assert [s for _, s in best] == sorted(exact.tolist(), reverse=True)[:5]
    assert sum(scored) < 2500


def slow_classes(rows, cosine):
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    links = Counter()
    for i, j in combinations(range(len(rows)), 2):
        (_, x, a), (_, y, b) = rows[i], rows[j]
        if a is None or a != b or not (sound(x) and sound(y)) or len(x) != len(y):
            continue
        x, y = np.array(x, dtype=np.float64), np.array(y, dtype=np.float64)
        norm = np.sqrt((x @ x) * (y @ y))
        if norm and x @ y / norm >= cosine:
            links[i] += 1
            links[j] += 1
            parent[root(i)] = root(j)
    names = {}
    for i, (key, _, _) in enumerate(rows):
        if key is not None:
            names[root(i)] = min(key, names.get(root(i), key))
    return Counter(
        (key, links[i], names.get(root(i)), key is not None and key == names.get(root(i)))
        for i, (key, _, _) in enumerate(rows)
    )


@pytest.mark.parametrize("tile", [4, 2048])
def test_classes_same_as_brute_force(odd_vectors, tile):
    rows = [(r.vec_id, r.embedding, r.label) for r in odd_vectors.collect()]
    found = pivots.classes(odd_vectors, tile=tile)
    assert Counter(map(tuple, found.collect())) == slow_classes(rows, 0.98)


def test_recall_of_near_vectors(spark):
    """Pairs just above the threshold in many dimensions, far from the pivots."""
    draw = np.random.default_rng(9)
    rows = []
    for i in range(400):
        x = draw.normal(size=64)
        y = x + draw.normal(size=64) * 0.19
        rows += [(2 * i, x.tolist(), 0), (2 * i + 1, y.tolist(), 0)]
    expected = sum(n * k[1] for k, n in slow_classes(rows, 0.98).items())
    found = pivots.classes(table(spark, rows)).agg(F.sum("n_links")).first()[0]
    assert expected > 300
    assert 0.99 * expected <= found <= expected


def test_no_vectors(spark):
    empty = table(spark, [])
    assert pivots.classes(empty).count() == 0
    assert topk.top(empty, F.col("vec_id") % 50 == 0).count() == 0


def test_components_of_chains_stars_and_loops(spark):
    chain = [(i, i + 1) for i in range(100, 140)]
    star = [(500, i) for i in range(501, 560)]
    edges = [*chain, *star, (7, 7), (1, 2), (2, 1), (3, 2), (-5, -9)]
    found = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    expected = {i: 100 for i in range(100, 141)} | {i: 500 for i in range(500, 560)}
    assert found == expected | {1: 1, 2: 1, 3: 1, -5: -9, -9: -9}


def recall_in_a_group(draw, n, dims=64, mean=0.985):
    """Of the near pairs in a group of a third of n vectors the part that shares pivots."""
    centre = draw.normal(size=dims)
    spread = np.linalg.norm(centre) * np.sqrt((1 / mean - 1) / dims)
    group = centre + draw.normal(size=(n // 3, dims)) * spread
    every = pivots._unit(np.concatenate([group, draw.normal(size=(n - n // 3, dims))]))
    size = min(max(int(n**0.5), pivots.PIVOTS[0]), pivots.PIVOTS[1])
    sample = every[draw.permutation(n)[:size]]
    points = pivots._thinned(sample, np.cos(2 * np.arccos(pivots.COSINE)), min(size, pivots.PIVOTS[0]))
    some = every[:300]
    known = np.argsort(-(some @ points.T), axis=1, kind="stable")[:, : pivots.FIRST]
    left, right = np.triu_indices(len(some), 1)
    near = np.einsum("ij,ij->i", some[left], some[right]) >= pivots.COSINE
    both = (known[left][:, :, None] == known[right][:, None, :]).any(axis=2).sum(axis=1)
    return near.sum(), (both[near] >= pivots.SHARED).mean()


@pytest.mark.parametrize("n", [600, 5000, 60_000])
def test_recall_inside_a_large_group_of_near_vectors(n):
    """A third of the rows are near but unequal; links must not thin out as n grows."""
    pairs, recall = recall_in_a_group(np.random.default_rng(n), n)
    assert pairs > 3000 and recall >= 0.999


def test_links_of_a_large_group_of_near_vectors(spark):
    draw = np.random.default_rng(12)
    centre = draw.normal(size=64)
    group = [centre + draw.normal(size=64) * 0.12 for _ in range(250)]
    rows = [(i, v.tolist(), 0) for i, v in enumerate([*group, *draw.normal(size=(500, 64))])]
    units = pivots._unit(np.array([v for _, v, _ in rows]))
    expected = int((np.triu(units @ units.T, 1) >= 0.98).sum()) * 2
    found = pivots.classes(table(spark, rows)).agg(F.sum("n_links")).first()[0]
    assert expected > 10_000 and 0.999 * expected <= found <= expected


def test_vectors_of_very_many_lengths(spark):
    """More lengths than pivots: each length has directions of its own."""
    draw = np.random.default_rng(2)
    rows = []
    for i in range(140):
        length = 1 + i // 2
        base = np.random.default_rng(length).normal(size=length)
        rows.append((i, (base + draw.normal(size=length) * 0.02).tolist(), 0))
    expected = slow_classes([(i, np.float32(v).tolist(), c) for i, v, c in rows], 0.98)
    found = pivots.classes(table(spark, rows))
    assert Counter(map(tuple, found.collect())) == expected
    assert sum(k[1] for k in expected) >= 130
    assert found.columns == ["vec_id", "n_links", "component_id", "kept"]


def test_rows_that_share_a_key_all_take_part(spark):
    """Each is a candidate for the others and has ranks of its own."""
    draw = np.random.default_rng(8)
    keys = [0, 0, 50, 50, 50, 7, 7, 3, 9, 11, 100]
    rows = [(k, draw.normal(size=4).tolist(), 0) for k in keys] + [(7, [1.0, 0.0, 0.0, 0.0], 0)] * 2
    held = [(i, [int(np.floor(256.0 * x)) for x in np.float32(v)]) for i, v, _ in rows]
    expected = Counter()
    for a, (q, w) in enumerate(held):
        if q % 50:
            continue
        scored = sorted(
            (-sum(x * y for x, y in zip(w, v, strict=True)), i) for b, (i, v) in enumerate(held) if a != b
        )
        expected.update((q, rank, i, -s) for rank, (s, i) in enumerate(scored[:5], 1))
    for blocks in ((8192, 1024), (3, 2)):
        found = topk.top(table(spark, rows), F.col("vec_id") % 50 == 0, rows=blocks[0], queries=blocks[1])
        assert Counter(map(tuple, found.collect())) == expected
