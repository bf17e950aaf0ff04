"""Near-duplicate vectors through a pivot-permutation index.

A vector is described by its nearest reference points, the pivots, in order. Vectors that
are near each other share most of their first pivots. The index lists vectors under each
pair of their first pivots; two vectors that share at least two meet in a list, the pivots
they share are counted, and pairs with enough are verified by their cosine. A pair counts
only in the list of the two least pivots that it shares.

Pivots are a bounded sample of the vectors, about the square root of their number, so lists
stay short as the input grows. Of sampled vectors near each other one is a pivot: members of
a large group of near vectors would rank many pivots among them by their own noise. Fixed
directions, made from the length alone, take the free places up to the fewest pivots, also
for lengths of which the sample has no vector. Equal vectors are one member with a weight,
and long lists are cut into tiles that many tasks share.
"""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import ArrayType, IntegerType

from staywise.llm import pairing
from staywise.llm.common import cut_lineage, partitions
from staywise.llm.components import components
from staywise.llm.topk import usable

COSINE = 0.98
#: Pivots of a vector that count, and how many of them a near pair must share.
FIRST, SHARED = 7, 2
#: Fewest and most pivots.
PIVOTS = (64, 4096)


def _unit(values: np.ndarray) -> np.ndarray:
    return values / np.sqrt((values * values).sum(axis=1, keepdims=True))


def _matrix(column: pa.Array | pa.ChunkedArray, length: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, length)


def _fixed(length: int, number: int) -> np.ndarray:
    """Directions that follow from the length."""
    return _unit(np.random.default_rng(length).normal(size=(number, length)))


def _nearest(pivots: dict[int, np.ndarray], first: int, fewest: int):
    """The numbers of a vector's nearest pivots, among those of its length, rising."""

    @arrow_udf(ArrayType(IntegerType()))
    def nearest(vectors: pa.Array) -> pa.Array:
        lengths = np.array([len(v) for v in vectors], dtype=np.int64)
        rows: list[list[int]] = [[]] * len(lengths)
        for length in np.unique(lengths):
            own = np.flatnonzero(lengths == length)
            points = pivots.get(int(length))
            points = _fixed(int(length), fewest) if points is None else points
            cosines = _unit(_matrix(vectors.take(pa.array(own)), int(length))) @ points.T
            ranked = np.argsort(-cosines, axis=1, kind="stable")[:, :first]
            for row, found in zip(own, np.sort(ranked, axis=1).tolist(), strict=True):
                rows[row] = found
        return pa.array(rows, pa.list_(pa.int32()))

    return nearest


def _thinned(units: np.ndarray, apart: float, fewest: int) -> np.ndarray:
    """Units, in order, without those at a cosine of ``apart`` or more to an earlier one that
    stays; fixed directions follow where fewer than ``fewest`` stay."""
    free = np.ones(len(units), dtype=bool)
    chosen = []
    for i in range(len(units)):
        if free[i]:
            chosen.append(i)
            free &= units @ units[i] < apart
    kept = units[chosen]
    missing = fewest - len(kept)
    if missing <= 0 or not units.shape[1]:
        return kept
    return np.concatenate([kept, _fixed(units.shape[1], missing)])


def _sample(
    distinct: DataFrame, size: int, fewest: int, cosine: float
) -> dict[int, np.ndarray]:
    """Pivots by vector length: the first ``size`` vectors by a hash, of whatever lengths, as
    units, thinned to twice the angle of ``cosine``."""
    apart = math.cos(min(2 * math.acos(max(-1.0, min(1.0, cosine))), math.pi))
    rows = distinct.orderBy(F.xxhash64("vector"), "node").limit(size).select("vector").collect()
    by_length: dict[int, list] = {}
    for row in rows:
        by_length.setdefault(len(row["vector"]), []).append(row["vector"])
    return {
        length: _thinned(_unit(np.array(vectors, dtype=np.float64)), apart, fewest)
        for length, vectors in by_length.items()
    }


def _found(cosine: float, shared: int, first: int):
    """Links of a tile: each member's weighted number of them, and a forest of them."""

    def found(table: pa.Table) -> pa.RecordBatch:
        n = table.num_rows
        nodes, weights = table.column("node").to_numpy(), table.column("weight").to_numpy()
        classes = table.column("class").to_numpy()
        lists = table.column("pivots").combine_chunks()
        sizes = np.diff(lists.offsets.to_numpy())
        known = np.full((n, first), -1, dtype=np.int32)
        known[np.arange(first) < sizes[:, None]] = lists.flatten().to_numpy()
        low, high = table.column("low").to_numpy(), table.column("high").to_numpy()
        vectors = table.column("vector").combine_chunks()
        lengths = np.diff(vectors.offsets.to_numpy())
        units = np.zeros((n, lengths.max()))
        units[np.arange(lengths.max()) < lengths[:, None]] = vectors.flatten().to_numpy()
        units = _unit(units)
        counts = np.zeros(n, dtype=np.int64)

        def links():
            for left, right in pairing.shifts(table):
                alike = (classes[left] == classes[right]) & (lengths[left] == lengths[right])
                left, right = left[alike], right[alike]
                mine = known[left]
                both = (mine[:, :, None] == known[right][:, None, :]).any(axis=2) & (mine >= 0)
                rank = both.cumsum(axis=1)
                least = np.where(both & (rank == 1), mine, 0).sum(axis=1)
                second = np.where(both & (rank == 2), mine, 0).sum(axis=1)
                meet = (rank[:, -1] >= shared) & (least == low[left]) & (second == high[left])
                left, right = left[meet], right[meet]
                near = np.einsum("ij,ij->i", units[left], units[right]) >= cosine
                left, right = left[near], right[near]
                np.add.at(counts, left, weights[right])
                np.add.at(counts, right, weights[left])
                yield left, right

        a, b = pairing.forest(n, links())
        linked = np.flatnonzero(counts)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([nodes[linked], nodes[a]])),
                pa.array(np.concatenate([counts[linked], nodes[b]])),
                pa.array(np.arange(len(linked) + len(a)) < len(linked)),
            ],
            ["a", "b", "is_count"],
        )

    return found


def _postings(
    distinct: DataFrame, pivots: dict[int, np.ndarray], first: int, fewest: int
) -> DataFrame:
    described = distinct.withColumn("pivots", _nearest(pivots, first, fewest)("vector"))
    places = [(i, j) for i in range(first) for j in range(i + 1, first)]
    pairs = F.array(
        *[
            F.struct(F.get("pivots", F.lit(i)).alias("low"), F.get("pivots", F.lit(j)).alias("high"))
            for i, j in places
        ]
    )
    listed = described.select("*", F.inline(pairs)).where("high is not null")
    return listed.withColumn("list", F.xxhash64("class", F.size("vector"), "low", "high"))


def _usable(vector: Column, label: Column) -> Column:
    squares = F.aggregate(vector, F.lit(0.0), lambda s, x: s + F.abs(x.cast("double")))
    return label.isNotNull() & usable(vector) & F.coalesce(squares > 0, F.lit(False))


def classes(
    vectors: DataFrame,
    cosine: float = COSINE,
    first: int = FIRST,
    shared: int = SHARED,
    pivots: int | None = None,
    tile: int = pairing.TILE,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
) -> DataFrame:
    """One row per vector: ``vec_id``, ``n_links``, ``component_id`` and ``kept``.

    Vectors link if their labels are equal, not null, and their cosine in doubles is at
    least ``cosine``; links below it are never made, links above it are found unless the two
    share fewer than ``shared`` of their ``first`` nearest pivots. ``n_links`` counts other
    rows, ``component_id`` is the smallest key that links reach, ``kept`` marks its bearer.
    Null and zero vectors, or with null or non-finite components, or without a label, link
    with nothing and keep themselves. Every row stays; null keys are members and name no
    class. Vectors link with those of their own length.
    """
    if not 2 <= shared <= first:
        raise ValueError("a pair meets under two shared pivots at least")
    rows = vectors.select(
        F.col(key).alias("vec_id"), F.col(vector).alias("vector"), F.col(label).alias("label")
    )
    fine = _usable(F.col("vector"), F.col("label"))
    distinct = cut_lineage(
        rows.where(fine)
        .groupBy("label", "vector")
        .agg(F.count("*").alias("weight"), F.min("vec_id").alias("least"))
        .select(
            "*",
            F.monotonically_increasing_id().alias("node"),
            F.xxhash64("label").alias("class"),
        )
    )
    n = distinct.count()
    size = pivots or min(max(math.isqrt(n), PIVOTS[0]), PIVOTS[1])
    fewest = min(size, PIVOTS[0])
    postings = _postings(
        distinct.select("node", "class", "vector", "weight"),
        _sample(distinct, size, fewest, cosine),
        first,
        fewest,
    )
    placed = pairing.tiled(postings, "list", F.xxhash64("node"), tile)
    found = cut_lineage(
        pairing.mapped(
            placed,
            _found(cosine, shared, first),
            "a bigint, b bigint, is_count boolean",
            2 * partitions(vectors.sparkSession),
        )
    )
    counts = found.where("is_count").groupBy("a").agg(F.sum("b").alias("others"))
    joined = components(found.where("not is_count").select("a", "b"))
    classed = (
        distinct.select("label", "vector", "weight", "least", "node")
        .join(counts.withColumnRenamed("a", "node"), "node", "left")
        .join(joined, "node", "left")
        .withColumn("component", F.coalesce("component", "node"))
    )
    names = classed.groupBy("component").agg(F.min("least").alias("component_id"))
    # A vector's equals are its links too.
    links = F.coalesce("others", F.lit(0)) + F.col("weight") - 1
    named = cut_lineage(
        classed.join(names, "component").select(
            "label", "vector", links.alias("n_links"), "component_id"
        )
    )
    linked = rows.where(fine).join(named, ["label", "vector"])
    alone = rows.where(~fine).select(
        "vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    every = linked.select("vec_id", "n_links", "component_id").unionByName(alone)
    return every.withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))
    )
