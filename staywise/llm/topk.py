"""Exact top-k by inner product with Fagin's threshold algorithm.

Rows are dealt into blocks, queries into groups; a task meets one block and one group. A
block keeps, per dimension, its rows sorted by their component. For a query the lists are
read in step, from the end that its weight favours; each row met is scored in full. The
weighted sum of the components last read bounds every row not met yet, so reading stops once
the k-th best score beats that bound. The blocks' best are merged per query.
"""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from staywise.llm.common import cut_lineage

K = 5
SCALE = 256.0
ROWS, QUERIES = 8192, 1024
_FIRST = 16
_LONG = (1 << 63) - 1


def usable(vector: Column) -> Column:
    """Not null, and all components finite."""
    sound = F.forall(
        vector,
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))),
    )
    return vector.isNotNull() & F.coalesce(sound, F.lit(False))


class Block:
    """Rows with their components in whole numbers, sorted per dimension."""

    def __init__(self, ids: np.ndarray, values: np.ndarray, rows: np.ndarray | None = None):
        self.ids, self.values = ids, values
        self.rows = ids if rows is None else rows
        self.order = np.argsort(values, axis=0, kind="stable")
        self.largest = float(np.abs(values).max(initial=0))

    def _scores(self, rows: np.ndarray, query: np.ndarray) -> np.ndarray:
        """Exact: in doubles where every sum fits in them, else in whole numbers of any size."""
        bound = self.largest * float(np.abs(query).max(initial=0)) * max(1, len(query))
        if bound < 2.0**53:
            return (self.values[rows] @ query).astype(np.int64)
        whole = [[int(x) for x in row] for row in self.values[rows]]
        weights = [int(x) for x in query]
        scores = [sum(a * b for a, b in zip(row, weights, strict=True)) for row in whole]
        return np.array(scores, dtype=object)

    def best(self, own: int, query: np.ndarray, k: int) -> list[tuple[int, int]]:
        """(row's key, score) of the k best, without the query's ``own`` row."""
        n = len(self.ids)
        used = np.flatnonzero(query)
        met = self.rows == own
        top_ids, top = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        depth, step = 0, _FIRST
        while depth < n:
            until = min(n, depth + step)
            places = np.arange(depth, until)
            reading = np.where(query[used] > 0, n - 1 - places[:, None], places[:, None])
            rows = np.unique(self.order[reading, used]) if len(used) else np.arange(n)
            rows = rows[~met[rows]]
            met[rows] = True
            if len(rows):
                scores = self._scores(rows, query)
                if len(top) + len(scores) > k:
                    scores, rows = _not_below(scores, rows, k)
                top = np.append(top, scores)
                top_ids = np.append(top_ids, self.ids[rows])
                order = sorted(range(len(top)), key=lambda i: (-top[i], top_ids[i]))[:k]
                top, top_ids = top[order], top_ids[order]
            if not len(used) or met.all():
                break
            if len(top) == k:
                last = self.values[self.order[reading[-1], used], used]
                bound = sum(int(a) * int(b) for a, b in zip(last, query[used], strict=True))
                # A row not met may still tie with the bound, and have the smaller key.
                if top[-1] > bound:
                    break
            depth, step = until, step * 2
        return list(zip(top_ids.tolist(), [int(s) for s in top], strict=True))


def _not_below(scores: np.ndarray, rows: np.ndarray, k: int):
    """Scores that are among the k best of these, ties included."""
    if len(scores) <= k:
        return scores, rows
    least = np.sort(scores)[-k]
    return scores[scores >= least], rows[scores >= least]


def _matrix(column: pa.ChunkedArray, scale: float) -> np.ndarray:
    n = len(column)
    flat = column.combine_chunks().flatten().to_numpy().astype(np.float64)
    return np.floor(scale * flat).reshape(n, len(flat) // n if n else 0)


def _search(k: int, scale: float):
    def task(rows: pa.Table, queries: pa.Table) -> pa.Table:
        found: list[tuple[int, int, int]] = []
        if rows.num_rows and queries.num_rows:
            ids, nodes = rows.column("vec_id").to_numpy(), rows.column("node").to_numpy()
            block = Block(ids, _matrix(rows.column("vector"), scale), nodes)
            weights = _matrix(queries.column("vector"), scale)
            asked = zip(
                queries.column("vec_id").to_pylist(), queries.column("node").to_pylist(), strict=True
            )
            for (own, node), query in zip(asked, weights, strict=True):
                found += [(own, node, row, score) for row, score in block.best(node, query, k)]
        own, node, row, scores = zip(*found, strict=True) if found else ((), (), (), ())
        return pa.table(
            {
                "query_id": pa.array(own, pa.int64()),
                "node": pa.array(node, pa.int64()),
                "vec_id": pa.array(row, pa.int64()),
                "score": pa.array([max(-_LONG, min(_LONG, s)) for s in scores], pa.int64()),
            }
        )

    return task


def top(
    vectors: DataFrame,
    is_query: Column,
    k: int = K,
    scale: float = SCALE,
    key: str = "vec_id",
    vector: str = "embedding",
    rows: int = ROWS,
    queries: int = QUERIES,
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query its ``k`` best other rows.

    Components count as ``floor(scale * x)``; ties go to the smaller key. Rows without a
    key, and vectors that are null or hold null or non-finite components, take no part. Rows
    that share a key are rows of their own: each is a candidate for the others, and each
    that asks has its own ranks. Vectors are compared with those of their own length. Scores
    beyond a long are cut to it.
    """
    single = cut_lineage(
        vectors.where(F.col(key).isNotNull() & usable(F.col(vector))).select(
            F.col(key).cast("bigint").alias("vec_id"),
            F.col(vector).alias("vector"),
            F.coalesce(is_query, F.lit(False)).alias("asks"),
            F.monotonically_increasing_id().alias("node"),
        )
    )
    n, asking = single.agg(F.count("*"), F.count_if("asks")).first()
    row_blocks, query_blocks = (max(1, math.ceil(m / size)) for m, size in ((n, rows), (asking, queries)))

    def dealt(df: DataFrame, own: str, blocks: int, other: str, others: int) -> DataFrame:
        return df.select(
            "vec_id",
            "node",
            "vector",
            F.size("vector").alias("length"),
            F.pmod(F.xxhash64("node"), F.lit(blocks)).cast("int").alias(own),
            F.explode(F.sequence(F.lit(0), F.lit(others - 1))).alias(other),
        )

    keys = ["length", "row_block", "query_block"]
    all_rows = dealt(single, "row_block", row_blocks, "query_block", query_blocks)
    # A table of their own: Spark does not tell the columns of two sides of one table apart.
    asked = cut_lineage(single.where("asks"))
    all_queries = dealt(asked, "query_block", query_blocks, "row_block", row_blocks)
    found = (
        all_rows.groupBy(*keys)
        .cogroup(all_queries.groupBy(*keys))
        .applyInArrow(_search(k, scale), "query_id bigint, node bigint, vec_id bigint, score bigint")
    )
    best = W.partitionBy("node").orderBy(F.desc("score"), "vec_id")
    return found.select(
        "query_id", F.row_number().over(best).alias("rank"), "vec_id", "score"
    ).where(F.col("rank") <= k)
