"""Repeated passages against brute force over all windows."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from staywise.llm import passages
from staywise.llm.common import stored_in_even_blocks


def slow(texts, window):
    split = [(t or "").encode().split() for t in texts]
    counts = Counter(
        tuple(w[i : i + window]) for w in split for i in range(len(w) - window + 1)
    )
    result = []
    for words in split:
        gone = [False] * len(words)
        for i in range(len(words) - window + 1):
            if counts[tuple(words[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        kept = b" ".join(w for w, g in zip(words, gone, strict=True) if not g).decode()
        result.append((len(words), sum(gone), kept))
    return result


@pytest.mark.parametrize("name", ["documents", "odd_documents", "no_documents"])
@pytest.mark.parametrize("window,phrase,shard", [(35, 18, 1 << 16), (35, 18, 7), (6, 3, 50), (4, 4, 9)])
def test_same_as_brute_force(name, window, phrase, shard, request, monkeypatch):
    docs = request.getfixturevalue(name).select("doc_id", "text")
    if window < 35:
        docs = docs.where("length(text) < 2000 or text is null")
    rows = docs.collect()
    expected = Counter(
        (r.doc_id, *e) for r, e in zip(rows, slow([r.text for r in rows], window), strict=True)
    )
    found = passages.drop_repeats(docs.repartition(3), window, phrase, shard)
    assert Counter(map(tuple, found.collect())) == expected


def test_long_texts_are_cut_without_loss():
    """A slice that cuts a text sees each of its windows once."""
    import numpy as np
    import pyarrow as pa

    words = [f"w{i % 50}" for i in range(400)]
    texts = pa.array([" ".join(words)])
    whole = passages.Vocabulary()
    numbers = whole.numbers([w.encode() for w in words])
    one = passages.Slice(numbers, np.array([400]), np.array(whole.hashes, np.uint64), 35, 18, passages.Powers())
    expected = np.sort(one.windows(np.arange(400 - 34)))
    saved = passages._SLICE
    try:
        passages._SLICE = 64
        found = []
        for piece, parts in passages._slices(texts, passages.Vocabulary(), 35, 18):
            begin = 0
            for _, _, n in parts:
                found.append(piece.windows(np.arange(begin, begin + n - 34)))
                begin += n
    finally:
        passages._SLICE = saved
    assert np.array_equal(np.sort(np.concatenate(found)), expected)


def found_and_expected(docs, rows, window=35, phrase=18, shard=1 << 14):
    found = Counter(map(tuple, passages.drop_repeats(docs, window, phrase, shard).collect()))
    texts = slow([r[1] for r in rows], window)
    return found, Counter((r[0], *e) for r, e in zip(rows, texts, strict=True))


@pytest.mark.parametrize("size", [1, 3000, 50_000])
def test_blocks_of_any_size(documents, size, monkeypatch):
    """Repeats within a block, across blocks, and across partitions."""
    monkeypatch.setattr(passages, "BLOCK", size)
    docs = documents.select("doc_id", "text").repartition(2)
    found, expected = found_and_expected(docs, docs.collect())
    assert found == expected


def test_one_huge_partition_is_cut_into_blocks(spark):
    """Blocks are bounded by bytes, not by the partition they come from."""
    docs = spark.range(3000).select(
        F.col("id").alias("doc_id"), F.repeat(F.lit("some words "), 100).alias("text")
    ).coalesce(1)
    stored = stored_in_even_blocks(docs, "text", 50_000)
    sizes = stored.groupBy("block").agg(F.sum(F.length("text")).alias("n")).collect()
    assert len(sizes) >= 60 and max(r.n for r in sizes) < 2 * 50_000
    assert stored.count() == 3000 and not spark.catalog.listTables()
    plan = stored.groupBy("block").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_marks_come_from_the_automata(documents, monkeypatch):
    """Without what the automata report, or with a part of it, less goes."""
    docs = documents.select("doc_id", "text")
    whole = sum(r.n_removed for r in passages.drop_repeats(docs).collect())
    assert whole > 0
    inner = passages.occurrences

    def none(pieces, vocabulary, phrases, shard):
        return [places & False for places in inner(pieces, vocabulary, phrases, shard)]

    def some(pieces, vocabulary, phrases, shard):
        return inner(pieces, vocabulary, phrases[::2], shard)

    monkeypatch.setattr(passages, "occurrences", some)
    half = sum(r.n_removed for r in passages.drop_repeats(docs).collect())
    monkeypatch.setattr(passages, "occurrences", none)
    assert sum(r.n_removed for r in passages.drop_repeats(docs).collect()) == 0 < half < whole


def test_occurrences_are_all_places_of_a_phrase():
    import random

    rng = random.Random(1)
    words = [rng.choice([b"a", b"b", "é".encode(), b"cc"]) for _ in range(3000)]
    vocabulary = passages.Vocabulary()
    numbers = vocabulary.numbers(words)
    hashes = np.array(vocabulary.hashes, np.uint64)
    piece = passages.Slice(numbers, np.array([3000]), hashes, 8, 4, passages.Powers())
    phrases = [b" ".join(words[i : i + 4]) for i in (0, 17, 400, 2996)] + [b"a b unknown cc"]
    expected = [b" ".join(words[i : i + 4]) in phrases for i in range(3000)]
    for shard in (1, 3, 100):
        (found,) = passages.occurrences([piece], vocabulary, phrases, shard)
        assert found.tolist() == expected


@pytest.mark.parametrize("kind", ["smallint", "double", "date", "binary", "decimal(9,2)"])
def test_keys_of_any_type(spark, kind):
    passage = " ".join(f"w{i}" for i in range(40))
    docs = spark.createDataFrame([(1, passage), (2, f"x {passage}"), (3, "own"), (None, None)], "k int, text string")
    key = F.to_date(F.concat(F.lit("2020-01-0"), F.col("k"))) if kind == "date" else F.col("k")
    if kind == "binary":
        key = key.cast("string")
    keyed = docs.select(key.cast(kind).alias("doc_id"), "text")
    found = passages.drop_repeats(keyed)
    assert found.schema["doc_id"].dataType.simpleString() == kind
    assert sorted((r.n_words, r.n_removed, r.kept) for r in found.collect()) == [
        (0, 0, ""), (1, 0, "own"), (40, 40, ""), (41, 40, "x")
    ]
