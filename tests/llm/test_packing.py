"""Packing: exact round trip, whole sequences, and how many there are."""

from collections import Counter, defaultdict
from itertools import combinations_with_replacement

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from staywise.llm import packing


def laid_out(rows):
    """Sequences as lists of (offset, length), checked to be gapless and within bounds."""
    sequences = defaultdict(list)
    for row in rows:
        sequences[row.sequence_id].append((row.offset, row.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY
    return sequences


@pytest.mark.parametrize("name", ["documents", "odd_documents"])
def test_round_trip(name, request):
    docs = request.getfixturevalue(name)
    parts = packing.pack(packing.pieces(docs)).collect()
    sequences = laid_out(parts)
    assert len(sequences) <= 1.02 * -(-sum(p.length for p in parts) // packing.CAPACITY) + 1
    tokenizer = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    expected = Counter()
    for row in docs.collect():
        ids = [*tokenizer.encode(row.text or "", add_special_tokens=False).ids, packing.END]
        expected[row.doc_id, np.array(ids, dtype="<u4").tobytes()] += 1
    found = defaultdict(list)
    for part in sorted(parts, key=lambda p: p.piece):
        found[part.doc_id].append(part)
    for (doc_id, ids), times in expected.items():
        if sum(1 for key, _ in expected if key == doc_id) > 1:
            continue
        own = found[doc_id]
        assert len({p.piece for p in own}) * times == len(own)
        single = own[::times]
        assert b"".join(p.ids for p in single) == ids
        assert [p.start for p in single] == [
            sum(q.length for q in single[:k]) for k in range(len(single))
        ]
        assert all(p.length == packing.CAPACITY for p in single[1:])


def test_no_documents(no_documents):
    assert packing.pack(packing.pieces(no_documents)).count() == 0


def test_lengths_out_of_range(spark):
    with pytest.raises(ValueError):
        packing.pack(spark.createDataFrame([(1, 0, 2000)], "doc_id long, piece int, length long"))


def fewest(sizes, capacity):
    """Brute force over ways to put sizes into sequences."""
    best = len(sizes)

    def place(k, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if k == len(sizes):
            best = len(rooms)
            return
        for i in range(len(rooms)):
            if rooms[i] >= sizes[k] and rooms[i] not in rooms[:i]:
                place(k + 1, rooms[:i] + [rooms[i] - sizes[k]] + rooms[i + 1 :])
        place(k + 1, [*rooms, capacity - sizes[k]])

    place(0, [])
    return best


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 30), min_size=1, max_size=9))
def test_optimal_on_few(sizes):
    sizes.sort(reverse=True)
    packed = packing.complete(dict(Counter(sizes)), 30)
    assert sorted((s for f, n in packed for s in f * n), reverse=True) == sizes
    assert all(sum(filling) <= 30 for filling, _ in packed)
    assert sum(n for _, n in packed) == fewest(sizes, 30)


def test_fillings_are_undominated_and_lead_with_least_waste():
    counts = {7: 2, 5: 1, 3: 4}
    found = list(packing.fillings(counts, 12))
    assert found[0] in ((7, 5),)
    sums = [sum(f) for f in found]
    assert sums == sorted(sums, reverse=True)
    every = {
        c
        for n in range(1, 5)
        for c in combinations_with_replacement((7, 5, 3), n)
        if sum(c) <= 12 and all(c.count(s) <= counts[s] for s in c)
    }
    assert set(found) <= every
    assert not {(), (7,), (5,), (3,)} & set(found)


def test_search_beats_best_fit():
    counts = {6: 2, 5: 2, 4: 2, 3: 2, 2: 2, 10: 1}
    best = sum(n for _, n in packing.complete(counts, 10))
    assert best == packing.lower_bound(counts, 10) == 5
    assert best <= sum(n for _, n in packing.best_fit(counts, 10))


def test_search_goes_on_to_the_bound():
    """Best-fit and 2,000 fillings take 22 sequences here; 21 are enough."""
    sizes = (
        "21 55 55 53 50 50 23 36 36 24 24 32 32 51 51 51 51 43 43 43 47 47 47 48 48 48 38 38 34 49 37 37 "
        "28 28 31 31 31 42 42 41 25 25 22 40 40 26 39 58 35 35 29 29 29 33"
    )
    counts = dict(Counter(map(int, sizes.split())))
    assert sum(n for _, n in packing.complete(counts, 100)) == packing.lower_bound(counts, 100) == 21
    assert sum(n for _, n in packing.complete(counts, 100, 2_000)) == 22


def fewest_of(counts, capacity):
    """Brute force over how often each length goes beside the largest one left."""
    from functools import cache

    sizes = sorted(counts, reverse=True)

    @cache
    def need(left):
        if not any(left):
            return 0
        first = next(i for i, n in enumerate(left) if n)
        options = [((), capacity - sizes[first])]
        for i, n in enumerate(left):
            n -= i == first
            options = [
                (taken + (k,), room - k * sizes[i])
                for taken, room in options
                for k in range(n + 1)
                if k * sizes[i] <= room
            ]
        return 1 + min(
            need(tuple(n - k - (i == first) for i, (n, k) in enumerate(zip(left, taken, strict=True))))
            for taken, _ in options
        )

    return need(tuple(counts[s] for s in sizes))


@settings(max_examples=120, deadline=None)
@given(st.dictionaries(st.integers(4, 25), st.integers(1, 4), min_size=1, max_size=5))
def test_optimal_with_repeated_lengths(counts):
    packed = packing.complete(counts, 50, 10**9)
    placed = Counter()
    for filling, n in packed:
        assert sum(filling) <= 50
        for size in filling:
            placed[size] += n
    assert placed == Counter(counts)
    assert sum(n for _, n in packed) == fewest_of(counts, 50)


def test_a_filling_is_used_less_often_than_it_could_be():
    """Using every filling as often as it can be takes 6 sequences here."""
    counts = {21: 4, 19: 3, 17: 3, 13: 1, 11: 3}
    assert sum(n for _, n in packing.complete(counts, 50, 10**9)) == 5 == fewest_of(counts, 50)


def test_columns_of_any_name(spark):
    rows = [(i, 0, 300 + i, i, f"r{i}", -i, "c") for i in range(20)]
    names = "doc_id long, piece int, length int, _row int, chunk string, rank int, kept string"
    parts = spark.createDataFrame(rows, names).withColumn("_chunk", F.lit(1)).withColumn("order", F.lit(2))
    found = packing.pack(parts)
    assert found.columns == [*parts.columns, "sequence_id", "offset"]
    assert sorted(tuple(r)[:-2] for r in found.collect()) == sorted(map(tuple, parts.collect()))
    laid_out(found.collect())


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=200) | st.lists(st.sampled_from(
    ["<|endoftext|>", "<|endoftext", " ", "  ", "\n", "\r\n", "\t", "a", "A's", "'ll", "é", "é", "日本", "😀", "0", "123",
     " ", " ", "﻿", "\x00", "\x85", "١٢", "ß", "_", "-", "...", "퟿", "\U0010ffff"]
), max_size=30).map("".join))
def test_ids_are_those_of_the_named_tokenizer(text):
    assert ENCODE(text) == TOKENIZER.encode(text, add_special_tokens=False).ids


def test_ids_of_all_texts(spark):
    for name in ("documents", "benchmark"):
        for row in spark.read.parquet(f"/root/testdata/sf0.01/{name}.parquet").select("text").collect():
            text = row.text or ""
            assert ENCODE(text) == TOKENIZER.encode(text, add_special_tokens=False).ids


ENCODE = packing.encoder()
TOKENIZER = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
