"""Importance resampling against spelled-out n-grams."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from staywise.llm import resampling

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def slow_features(text, buckets=10_000, width=3):
    words = WORDS.findall((text or "").translate(LOWER))
    runs = [
        " ".join(words[i : i + k]) for k in range(1, width + 1) for i in range(len(words) - k + 1)
    ]
    return len(words), Counter(zlib.crc32(r.encode()) % buckets for r in runs)


def slow_resample(docs, target, percent=5, least=20):
    bags = [(i, *slow_features(t)) for i, t in docs]
    s, t = Counter(), Counter()
    for _, _, bag in bags:
        s.update(bag)
    for text in target:
        t.update(slow_features(text)[1])
    of_s, of_t = s.total() + 10_000, t.total() + 10_000
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * of_s / ((s[b] + 1) * of_t))) for b in {*s, *t}}
    rows = []
    for i, n_words, bag in bags:
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(n * gain[b] for b, n in bag.items())
        noise = math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([i, bag.total(), weight, weight + noise, n_words >= least])
    fit = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    ranks = [k + 1 if k < len(fit) * percent // 100 else None for k in range(len(fit))]
    drawn = Counter((*r[:4], k) for r, k in zip(fit, ranks, strict=True))
    return drawn + Counter((*r[:4], None) for r in rows if not r[4])


def test_chunks_and_long_texts():
    """However texts are joined and cut, the features are those of whole texts."""
    rng = random.Random(5)
    vocabulary = ["a", "B", "été", "x9", "ß" * 40, "w" * 70, "long" * 60, "z" * 3000, "日本"]
    gaps = [" ", "  ", "-", "\n", "\x00", ".\t"]
    texts = [
        "".join(rng.choice(vocabulary) + rng.choice(gaps) for _ in range(rng.choice([0, 1, 2, 3, 9, 400])))
        for _ in range(40)
    ] + ["", "\x00", "one", "y" * 20_000]
    expected = [slow_features(t, 997) for t in texts]
    for chunk in (1, 50, 3000, 1 << 22):
        n, bags = [0] * len(texts), [Counter() for _ in texts]
        features = resampling.Features(997, 3, chunk)
        for first, count, words, grams in features(t.encode() for t in texts):
            assert len(words) == count
            for k, w in enumerate(words):
                n[first + k] += int(w)
            for found, docs in grams:
                for bucket, doc in zip(found.tolist(), docs.tolist(), strict=True):
                    bags[first + doc][bucket] += 1
        assert list(zip(n, bags, strict=True)) == expected


@pytest.mark.parametrize("name", ["documents", "odd_documents"])
def test_draw(spark, name, request, sf_dir):
    docs = request.getfixturevalue(name)
    target = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    percent = 5 if name == "documents" else 60
    found = resampling.resample(docs, target, percent)
    assert found.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    expected = slow_resample(
        [(r.doc_id, r.text) for r in docs.collect()], [r.text for r in target.collect()], percent
    )
    assert Counter(map(tuple, found.collect())) == expected
    assert any(r[4] for r in expected)
    kept = resampling.resample(docs.repartition(5), target, percent, keep=docs.columns)
    again = Counter(tuple(r[c] for c in found.columns) for r in kept.collect())
    assert again == expected


def test_nothing_to_draw_from(spark, documents, no_documents):
    assert resampling.resample(no_documents, documents).collect() == []
    rows = resampling.resample(documents, no_documents).collect()
    assert len(rows) == documents.count() and any(r.rank == 1 for r in rows)


def test_a_third_of_equal_rows_is_ranked(spark):
    docs = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, F.lit(None).cast("long")).otherwise(F.col("id")).alias("doc_id"),
        F.when(F.col("id") % 3 == 0, F.lit("same " * 25)).otherwise(
            F.concat_ws(" ", *[F.lit(f"w{k}") for k in range(19)], F.col("id"))
        ).alias("text"),
    )
    rows = resampling.resample(docs, docs.limit(3), percent=70).collect()
    assert sorted(r["rank"] for r in rows if r["rank"]) == list(range(1, 4201))
    by_rank = sorted((r for r in rows if r["rank"]), key=lambda r: r["rank"])
    order = [(-r.score, r.doc_id is None, r.doc_id or 0) for r in by_rank]
    assert order == sorted(order)


def test_gain_of_buckets(spark):
    pairs = lambda rows: spark.createDataFrame(rows, "bucket int, n bigint")
    gain = resampling.gains(pairs([(0, 3), (2, 1)]), pairs([(0, 1)]), 3)
    expected = [math.floor(1000 * math.log(x)) for x in (2 * 7 / (4 * 4), 7 / 4, 7 / (2 * 4))]
    assert np.array_equal(gain, expected)
