"""Slots and their map: near equal bytes, gapless places, edits that move little."""

import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from staywise.llm import sharding
from staywise.llm.common import new_folder


def laid_out(rows, shards=sharding.SHARDS):
    """Sizes per shard; places are gapless and a virtual slot lies in one shard."""
    places, sizes, home = defaultdict(list), Counter(), {}
    for r in rows:
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < shards
        places[r.shard].append(r.slot)
        sizes[r.shard] += r["size"]
        assert home.setdefault(r.virtual_slot, r.shard) == r.shard
    for found in places.values():
        assert sorted(found) == list(range(len(found)))
    return [sizes[s] for s in range(shards)]


@pytest.mark.parametrize("name", ["documents", "odd_documents"])
def test_place(name, request):
    docs = request.getfixturevalue(name)
    rows = sharding.place(docs, keep=docs.columns).collect()
    texts = [(r.doc_id, (r.text or "").encode()) for r in docs.collect()]
    expected = Counter((i, len(t) + 1, zlib.crc32(t)) for i, t in texts)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in rows) == expected
    sizes = laid_out(rows)
    heaviest = Counter()
    for r in rows:
        heaviest[r.virtual_slot] += r["size"]
    assert max(sizes) - min(sizes) <= max(heaviest.values())
    assert [f for f in rows[0].asDict() if f not in sharding.ADDED] == [
        c for c in docs.columns if c != "size"
    ]


def test_nothing_to_place(no_documents):
    assert sharding.place(no_documents).collect() == []


def test_a_third_of_equal_rows(spark):
    """Rows equal in key and text lie in many slots, and shards stay even."""
    docs = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("doc_id"),
        F.when(F.col("id") % 3 == 0, F.lit("copied " * 30)).otherwise(
            F.repeat(F.lit("own "), (F.col("id") % 50).cast("int"))
        ).alias("text"),
    )
    rows = sharding.place(docs).collect()
    sizes = laid_out(rows)
    assert max(sizes) <= 1.005 * min(sizes)
    copied = Counter(r.virtual_slot for r in rows if r.doc_id == 7)
    assert max(copied.values()) <= 30_000 / sharding.SLOTS * sharding.HEAVY * 3
    # Small rows count too: a third without text under one key.
    blank = docs.withColumn("text", F.when(F.col("doc_id") != 7, F.col("text")))
    widths = Counter(r.virtual_slot for r in sharding.place(blank).collect())
    assert max(widths.values()) <= 30_000 / sharding.SLOTS * sharding.HEAVY * 3


def as_dict(df):
    rows = df.collect()
    found = {r.virtual_slot: r.shard for r in rows}
    assert len(found) == len(rows)
    return found


def loads(found, weighed, shards):
    total = Counter({s: 0 for s in range(shards)})
    for r in weighed:
        total[found[r.virtual_slot]] += r.bytes
    return [total[s] for s in range(shards)]


def slow_edit(before, weighed, shards):
    """Largest slots stay while they fit into the shard's part, the rest is dealt."""
    size = {r.virtual_slot: r.bytes for r in weighed}
    slots = sorted({*before, *size}, key=lambda s: (-size.get(s, 0), s))
    total, load, after, spare = sum(size.values()), [0] * shards, {}, []
    upto = [0] * shards
    for slot in slots:
        shard, n = before.get(slot), size.get(slot, 0)
        if shard is not None and shard < shards:
            upto[shard] += n
            if upto[shard] * shards <= total:
                after[slot], load[shard] = shard, load[shard] + n
                continue
        spare.append(slot)
    for slot in spare:
        after[slot] = load.index(min(load))
        load[after[slot]] += size.get(slot, 0)
    return after


def test_edits(spark):
    sized = [(s, (s * s * 7919) % 1000 + 1, 3) for s in range(500)]
    weighed = spark.createDataFrame(sized, "virtual_slot int, bytes bigint, rows bigint")
    rows = weighed.collect()
    first = sharding.first_map(weighed, 5)
    even = sharding.rebalanced(first, weighed, 5)
    found = as_dict(even)
    assert found == slow_edit(as_dict(first), rows, 5)
    bytes_of = {r.virtual_slot: r.bytes for r in rows}
    largest = max(bytes_of[s] for s, shard in as_dict(first).items() if found[s] != shard)
    assert max(loads(found, rows, 5)) - min(loads(found, rows, 5)) <= largest
    # Nothing to do: nearly nothing moves.
    again = as_dict(sharding.rebalanced(even, weighed, 5))
    assert sum(again[s] != found[s] for s in found) <= 10
    # One more shard takes about a sixth, and only that moves.
    grown = as_dict(sharding.rebalanced(even, weighed, 6))
    assert grown == slow_edit(found, rows, 6)
    moved = [s for s in found if grown[s] != found[s]]
    assert sum(bytes_of[s] for s in moved) <= 1.1 * sum(bytes_of.values()) / 6
    # A shard less: all of its slots find another place.
    fewer = as_dict(sharding.rebalanced(even, weighed, 4))
    assert fewer == slow_edit(found, rows, 4) and set(fewer.values()) == set(range(4))
    # Slots that are new, and slots without rows.
    some = weighed.where("virtual_slot < 400 or virtual_slot >= 450")
    part = first.where("virtual_slot < 450")
    changed = as_dict(sharding.rebalanced(part, some, 5))
    assert changed == slow_edit(as_dict(part), some.collect(), 5) and len(changed) == 500


def test_versions(spark, documents):
    """A map that is there already is edited, and every version can be read again."""
    folder = new_folder(spark, "maps")
    few = documents.where("doc_id % 2 = 0")
    sharding.store(sharding.first_map(sharding.weights(
        few.select(F.lit(1).alias("virtual_slot"), F.lit(1).alias("size"))
    ), 3), folder, 1)
    laid_out(sharding.place(few, 3, folder).collect(), 3)
    second = as_dict(sharding.stored(spark, folder))
    rows = sharding.place(documents, 4, folder).collect()
    sizes = laid_out(rows, 4)
    assert max(sizes) - min(sizes) <= max(r["size"] for r in rows)
    assert {r.version for r in rows} == {3}
    assert as_dict(sharding.stored(spark, folder, 2)) == second
    third = as_dict(sharding.stored(spark, folder))
    assert set(second) <= set(third) and {r.virtual_slot: r.shard for r in rows}.items() <= third.items()
