"""Compare the members of many groups inside tasks, without emitting their pairs.

Groups of any size are cut into tiles of bounded size. A task meets the rows of one tile, or
of two tiles of the same group, so a hot group is shared out over many tasks and none holds
it whole. What leaves a task is a forest of links, at most one per member and tile.
"""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TILE = 2048
#: Columns that place a row in a tile or a pair of tiles.
PLACE = ("_group", "_a", "_b", "_own")


def tiled(rows: DataFrame, group: str, spread: Column, tile: int = TILE) -> DataFrame:
    """Rows of groups with at least two members, once per pair of tiles they belong to.

    ``spread`` deals a group's rows over its tiles. Tiles number so that each has about
    ``tile`` rows; a group of up to ``tile`` rows is one tile.
    """
    sizes = rows.groupBy(group).agg(F.count("*").alias("_n")).where("_n > 1")
    tiles = F.ceil(F.col("_n") / tile).cast("int")
    own = F.pmod(spread, tiles).cast("int")
    other = F.explode(F.sequence(F.lit(0), tiles - 1))
    return (
        rows.join(sizes, group)
        .select(*rows.columns, own.alias("_own"), other.alias("_other"))
        .select(
            *[c for c in rows.columns if c != group],
            F.col(group).alias("_group"),
            F.least("_own", "_other").alias("_a"),
            F.greatest("_own", "_other").alias("_b"),
            "_own",
        )
    )


def gathered(placed: DataFrame, partitions: int) -> DataFrame:
    keys = ["_group", "_a", "_b"]
    return placed.repartition(partitions, *keys).sortWithinPartitions(*keys)


def whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Cut a sorted stream into tables that hold whole groups; cuts never split a tile."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows == 0:
            continue
        last = [batch.column(k)[batch.num_rows - 1] for k in PLACE[:3]]
        same = np.ones(batch.num_rows, dtype=bool)
        for key, value in zip(PLACE, last, strict=False):
            same &= np.asarray(batch.column(key)) == value.as_py()
        begin = batch.num_rows - int(same[::-1].argmin() if not same.all() else len(same))
        if begin == 0 and held:
            first = held[0]
            tail = [first.column(k)[first.num_rows - 1].as_py() for k in PLACE[:3]]
            if tail == [v.as_py() for v in last]:
                held.append(batch)
                continue
        yield pa.Table.from_batches([*held, batch.slice(0, begin)])
        held = [batch.slice(begin)]
    if held:
        yield pa.Table.from_batches(held)


def shifts(table: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of rows to compare, a vector at a time: i and i + 1, then i and i + 2.

    Two rows meet if they share a tile, or lie in the two tiles of a pair.
    """
    group, a, b, own = (table.column(k).to_numpy() for k in PLACE)
    n = len(group)
    new = np.ones(n, dtype=bool)
    new[1:] = (np.diff(group) != 0) | (np.diff(a) != 0) | (np.diff(b) != 0)
    end = np.append(np.flatnonzero(new)[1:], n)[np.cumsum(new) - 1]
    cross = a != b
    left = np.arange(n)
    step = 1
    while len(left := left[left + step < end[left]]):
        right = left + step
        meet = ~cross[left] | (own[left] != own[right])
        yield left[meet], right[meet]
        step += 1


def forest(
    n: int, links: Iterator[tuple[np.ndarray, np.ndarray]]
) -> tuple[np.ndarray, np.ndarray]:
    """Of the links between n rows those that join two parts, in order of arrival."""
    part = np.arange(n)
    kept: list[tuple[int, int]] = []
    for left, right in links:
        new = part[left] != part[right]
        if not new.any():
            continue
        root = part
        for i, j in zip(left[new].tolist(), right[new].tolist(), strict=True):
            x, y = i, j
            while root[x] != x:
                x = root[x]
            while root[y] != y:
                y = root[y]
            if x != y:
                root[max(x, y)] = min(x, y)
                kept.append((i, j))
        while True:
            above = part[part]
            if np.array_equal(above, part):
                break
            part = above
    pairs = np.array(kept, dtype=np.int64).reshape(-1, 2)
    return pairs[:, 0], pairs[:, 1]


def mapped(
    placed: DataFrame, found: Callable[[pa.Table], pa.RecordBatch], schema: str, partitions: int
) -> DataFrame:
    """Apply ``found`` to tables of whole groups."""

    def task(batches):
        for table in whole_groups(batches):
            if table.num_rows:
                yield found(table)

    return gathered(placed, partitions).mapInArrow(task, schema)
