"""SimHash classes against brute force over all pairs."""

from itertools import combinations

import numpy as np
import pytest
import xxhash
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from staywise.llm import pairing, simhash


def slow_print(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(
        1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes)
    )


def slow_classes(rows, bits=4):
    prints = {i: slow_print(t) for i, (_, t) in enumerate(rows)}
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        if (prints[i] ^ prints[j]).bit_count() <= bits:
            parent[root(j)] = root(i)
    keys = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            keys[root(i)] = min(key, keys.get(root(i), key))
    return sorted((str(k), prints[i], str(keys.get(root(i)))) for i, (k, _) in enumerate(rows))


@pytest.mark.parametrize("name", ["documents", "odd_documents", "no_documents"])
@pytest.mark.parametrize("tile", [2, pairing.TILE])
def test_same_as_brute_force(name, tile, request):
    docs = request.getfixturevalue(name)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    found = simhash.classes(docs, tile=tile).collect()
    assert slow_classes(rows) == sorted(
        (str(r.doc_id), r.print % (1 << 64), str(r.component_id)) for r in found
    )


@pytest.mark.parametrize("tile", [3, 50, 4096])
def test_a_large_group_of_near_prints_stays_whole(spark, tile):
    """Chains and hubs: prints within few bits of each other, in one list and across."""
    draw = np.random.default_rng(3)
    centre = int(draw.integers(0, 1 << 63))
    prints = {centre}
    while len(prints) < 160:
        flip = sum(1 << int(b) for b in draw.choice(64, 3, replace=False))
        known = sorted(prints)
        prints.add(known[int(draw.integers(0, min(40, len(known))))] ^ flip)
    prints = [p - (1 << 64) if p >= 1 << 63 else p for p in sorted(prints)]
    table = spark.createDataFrame([(p,) for p in prints], "print long")
    links = {(r.a, r.b) for r in simhash.links(table, tile=tile).collect()}
    assert all(((a ^ b) % (1 << 64)).bit_count() <= 4 for a, b in links)

    def parts(pairs):
        parent = {p: p for p in prints}

        def root(p):
            while parent[p] != p:
                p = parent[p]
            return p

        for a, b in pairs:
            parent[root(a)] = root(b)
        groups = {}
        for p in prints:
            groups.setdefault(root(p), set()).add(p)
        return sorted(map(sorted, groups.values()))

    near = [
        (a, b) for a, b in combinations(prints, 2) if ((a ^ b) % (1 << 64)).bit_count() <= 4
    ]
    assert parts(links) == parts(near)


def test_every_four_positions_hold_a_triple():
    assert len(simhash.TRIPLES) == 20
    for four in combinations(range(8), 4):
        assert any(set(t) <= set(four) for t in simhash.TRIPLES)


@given(st.text(alphabet="aAbB \t\n é", max_size=60))
def test_fingerprint(text):
    assert simhash.fingerprint(text.encode()) == slow_print(text)


def test_keeps_one_of_each_class(documents, odd_documents, no_documents):
    for docs in (documents, odd_documents, no_documents):
        kept = simhash.keep_one(docs)
        assert kept.columns == docs.columns
        classed = simhash.classes(docs).select("print", "component_id").distinct().collect()
        # A class without a key is told by its print.
        classes = {r.component_id if r.component_id is not None else f"p{r.print}" for r in classed}
        assert kept.count() == len(classes)


def test_one_of_each_class_with_all_its_columns(spark, odd_documents):
    """Columns may be named like the operator's own; keys may repeat with other texts."""
    rows = [
        (1, "a b c d e f", "k1", 1), (2, "a b c d e f", "k2", 2), (2, "quite another text here", "k3", 3),
        (1, "a b c d e f", "k1", 1), (None, "no key", "k4", 4), (None, None, "k5", 5),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _row string, row int")
    docs = docs.withColumns({"_id": F.lit(0), "KEY": F.lit(1), "component": F.lit(2), "print": F.lit(3)})
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.row for r in kept.collect()) == [1, 3, 4, 5]
    found = simhash.keep_one(odd_documents)
    names = {name for _, _, name in slow_classes([(r.doc_id, r.text) for r in odd_documents.collect()])}
    assert {str(r.doc_id) for r in found.collect()} == names and found.columns == odd_documents.columns


def test_classes_with_one_smallest_key_stay_apart(spark):
    """A key with two texts names two classes; one row of either stays."""
    a, b = (" ".join(f"{c}{i}" for i in range(60)) for c in "ab")
    docs = spark.createDataFrame([(1, a), (1, b), (2, a), (3, b)], "doc_id long, text string")
    assert sorted(map(tuple, simhash.keep_one(docs).collect())) == [(1, a), (1, b)]
