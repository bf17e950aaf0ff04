"""Pack documents into sequences by bin completion with branch and bound.

Lengths are whole numbers up to the capacity, so a histogram of lengths, at most one row
per possible length, says all that packing needs to know. The search fills one sequence at
a time around the largest length left: it enumerates undominated fillings of the rest,
least waste first, applies a filling as often as the histogram allows, then fewer times, and
backtracks where the waste so far rules out beating the incumbent. Best-fit decreasing gives the first
incumbent, and a lower bound on the sequences ends the search.

The search works on the histogram in the driver, whatever the number of documents. Its
result is a table of fillings, whose size depends on the capacity alone. Documents take
their places by their rank among those of the same length; ranks are counted in chunks,
so a length that very many documents share is not gathered anywhere.
"""

import base64
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from staywise.llm.common import cut_lineage

CAPACITY = 1024
END = 2
SPECIAL = {"<|endoftext|>": 50256}
RANKS, TOKENIZER = "byte_bpe_50k.tiktoken", "byte_bpe_50k.json"
#: Fillings tried before the search settles for its incumbent.
NODES = 5_000
PIECE = (
    ("piece", pa.int32(), "int"),
    ("start", pa.int64(), "bigint"),
    ("length", pa.int64(), "bigint"),
    ("ids", pa.binary(), "binary"),
)


def encoder(folder: str | None = None):
    """Text to ids. The rank file holds the tokenizer's vocabulary and gives its ids faster;
    a text that the rank encoder gives up on goes to the tokenizer itself."""
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    def place(name):
        return f"{folder}/{name}" if folder else public_tokenizers.path(name)

    with open(place(RANKS), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    fast = tiktoken.Encoding(
        "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=SPECIAL
    )
    slow = []

    def encode(text: str) -> list[int]:
        try:
            return fast.encode(text, allowed_special="all")
        except BaseException as error:
            if type(error).__name__ not in ("PanicException", "ValueError"):
                raise
            slow[:] = slow or [Tokenizer.from_file(place(TOKENIZER))]
            return slow[0].encode(text, add_special_tokens=False).ids

    return encode


def pieces(
    docs: DataFrame,
    capacity: int = CAPACITY,
    end: int = END,
    text: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
    tokenizers: str | None = None,
) -> DataFrame:
    """Token ids of each document and ``end``, cut where longer than ``capacity``.

    Columns ``keep``, ``piece`` from 0, ``start``, ``length``, and ``ids`` as unsigned
    little-endian 32-bit numbers. All pieces of a cut document have ``capacity`` ids, but
    for the first, which may be shorter. A null text is empty, one piece with ``end``.
    """
    source = docs.select(*keep, F.col(text).alias("_text"))
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in source.schema[: len(keep)])
    added = ", ".join(f"{name} {kind}" for name, _, kind in PIECE)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizers)
        for batch in batches:
            rows, cut = [], {name: [] for name, _, _ in PIECE}
            held = 0
            for k, value in enumerate(batch.column("_text")):
                ids = np.array([*encode(value.as_py() or ""), end], dtype="<u4")
                first = len(ids) if len(ids) <= capacity else len(ids) % capacity or capacity
                bounds = [0, *range(first, len(ids) + 1, capacity)]
                for piece, (i, j) in enumerate(zip(bounds, bounds[1:], strict=False)):
                    rows.append(k)
                    for name, part in zip(cut, (piece, i, j - i, ids[i:j].tobytes()), strict=True):
                        cut[name].append(part)
                held += len(ids)
                if held >= 1 << 21:
                    yield _batch(batch, keep, rows, cut)
                    rows, cut, held = [], {name: [] for name, _, _ in PIECE}, 0
            if rows:
                yield _batch(batch, keep, rows, cut)

    return source.mapInArrow(task, f"{fields}, {added}")


def _batch(batch: pa.RecordBatch, keep, rows: list[int], cut: dict) -> pa.RecordBatch:
    index = pa.array(rows, pa.int32())
    return pa.RecordBatch.from_arrays(
        [
            *[batch.column(name).take(index) for name in keep],
            *[pa.array(cut[name], kind) for name, kind, _ in PIECE],
        ],
        [*keep, *cut],
    )


Bin = tuple[int, ...]


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """Fewest sequences: for each small length k, those over half the capacity need one
    each, those up to k fit beside them for free, and the rest must fit what room is left."""
    number, total = np.zeros(capacity + 1, dtype=np.int64), np.zeros(capacity + 1, dtype=np.int64)
    for size, n in counts.items():
        number[size], total[size] = n, size * n
    number, total = number.cumsum(), total.cumsum()
    half = capacity // 2
    best = 0
    for k in range(half + 1):
        large = number[capacity] - number[half]
        room = capacity * (number[capacity - k] - number[half]) - (total[capacity - k] - total[half])
        rest = total[half] - total[max(k - 1, 0)]
        best = max(best, int(large) + max(0, -(-int(rest - room) // capacity)))
    return best


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[Bin, int]]:
    """Best-fit decreasing over a histogram: fillings and how often each is used."""
    rooms: dict[int, dict[Bin, int]] = {}
    for size in sorted(counts, reverse=True):
        left = counts[size]
        while left:
            room = min((r for r in rooms if r >= size), default=None)
            if room is None:
                filling, bins = (), left
                room = capacity
            else:
                filling, bins = next(iter(rooms[room].items()))
            each = min(room // size, left)
            used = min(bins, left // each)
            if room in rooms and filling in rooms[room]:
                rooms[room][filling] -= used
                if not rooms[room][filling]:
                    del rooms[room][filling]
                if not rooms[room]:
                    del rooms[room]
            after = rooms.setdefault(room - each * size, {})
            grown = filling + (size,) * each
            after[grown] = after.get(grown, 0) + used
            left -= used * each
    return [(filling, n) for room in rooms.values() for filling, n in room.items()]


def _dominated(filling: Bin, waste: int, spare: int) -> bool:
    """Whether an unused length, a bit of ``spare``, fits too, or could take the place of
    one or two."""
    if spare & ((2 << waste) - 1):
        return True
    alone = (1 << waste) - 1
    if any(spare >> (taken + 1) & alone for taken in set(filling)):
        return True
    pair = (2 << waste) - 1
    return any(
        spare >> (x + y) & pair for i, x in enumerate(filling) for y in filling[i + 1 :]
    )


def fillings(counts: dict[int, int], room: int) -> Iterator[Bin]:
    """Undominated ways to fill ``room``, least waste first, larger lengths first."""
    sizes = [s for s in sorted(counts, reverse=True) if s <= room and counts[s]]
    # after[i]: the sums that lengths from place i on can reach, as bits.
    after = [1] * (len(sizes) + 1)
    mask = (1 << (room + 1)) - 1
    for i in range(len(sizes) - 1, -1, -1):
        reach = after[i + 1]
        left, power = min(counts[sizes[i]], room // sizes[i]), 1
        while left:
            step = min(power, left)
            reach |= (reach << (step * sizes[i])) & mask
            left -= step
            power *= 2
        after[i] = reach

    def exact(i: int, rest: int) -> Iterator[Bin]:
        if not rest:
            yield ()
        elif i < len(sizes) and after[i] >> rest & 1:
            for times in range(min(counts[sizes[i]], rest // sizes[i]), -1, -1):
                for more in exact(i + 1, rest - times * sizes[i]):
                    yield (sizes[i],) * times + more

    some = sum(1 << s for s in sizes)
    for waste in range(room + 1):
        if not after[0] >> (room - waste) & 1:
            continue
        for filling in exact(0, room - waste):
            spare = some
            for size in set(filling):
                if counts[size] == filling.count(size):
                    spare ^= 1 << size
            if not _dominated(filling, waste, spare):
                yield filling


class _Search:
    """Depth-first over fillings around the largest length left, with the best result so far."""

    def __init__(self, counts: dict[int, int], capacity: int, nodes: int):
        self.counts, self.capacity, self.nodes = counts, capacity, nodes
        self.total = sum(size * n for size, n in counts.items())
        self.bound = lower_bound(counts, capacity)
        self.best = best_fit(counts, capacity)
        self.fewest = sum(n for _, n in self.best)

    def _steps(self, left: dict[int, int], before: Bin | None, fewer: bool):
        """Fillings with how often to use each: as often as may be, and then fewer times.

        Fewer uses of the filling ``before`` have been tried already, as more uses of it.
        """
        largest = max(left)
        others = dict(left)
        others[largest] -= 1
        for rest in fillings(others, self.capacity - largest):
            filling = (largest, *rest)
            if filling == before:
                continue
            most = min(left[size] // filling.count(size) for size in set(filling))
            for times in range(most, 0 if fewer else most - 1, -1):
                yield filling, times

    def run(self, fewer: bool) -> None:
        """Go on until the bound is met, nothing is left to try, or the nodes are used up."""
        left, chosen = dict(self.counts), []
        used = wasted = 0

        def apply(filling: Bin, times: int) -> None:
            nonlocal used, wasted
            for size in set(filling):
                n = left.get(size, 0) - times * filling.count(size)
                if n:
                    left[size] = n
                else:
                    left.pop(size, None)
            used += times
            wasted += times * (self.capacity - sum(filling))

        def undo() -> None:
            filling, times = chosen.pop()
            apply(filling, -times)

        stack = [self._steps(left, None, fewer)] if left else []
        while stack and self.nodes and self.fewest > self.bound:
            step = next(stack[-1], None)
            if step is None:
                stack.pop()
                if chosen:
                    undo()
                continue
            self.nodes -= 1
            filling, times = step
            waste = times * (self.capacity - sum(filling))
            # What a better packing may waste in all.
            if wasted + waste > (self.fewest - 1) * self.capacity - self.total:
                continue
            apply(filling, times)
            chosen.append(step)
            if left:
                stack.append(self._steps(left, filling if fewer else None, fewer))
                continue
            if used < self.fewest:
                self.best, self.fewest = list(chosen), used
            undo()


def complete(
    counts: dict[int, int], capacity: int = CAPACITY, nodes: int = NODES
) -> list[tuple[Bin, int]]:
    """Fillings and how often each is used, for all of ``counts``: lengths to numbers.

    A first search uses each filling as often as it can, which suits long histograms; if that
    has nothing left to try, a second one branches on how often a filling is used as well.
    The result is optimal if it meets the lower bound or both end within ``nodes`` fillings;
    else it is the best that was found.
    """
    search = _Search({size: n for size, n in counts.items() if n}, capacity, nodes)
    search.run(fewer=False)
    search.run(fewer=True)
    return search.best


def _slots(packed: list[tuple[Bin, int]]) -> np.ndarray:
    """Rows (length, first rank, per sequence, first sequence, first offset), sorted."""
    ranks: dict[int, int] = {}
    rows, sequence = [], 0
    for filling, times in packed:
        offset = 0
        for size in sorted(set(filling), reverse=True):
            each = filling.count(size)
            rank = ranks.get(size, 0)
            rows.append((size, rank, each, sequence, offset))
            ranks[size] = rank + each * times
            offset += each * size
        sequence += times
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)


def pack(
    parts: DataFrame,
    capacity: int = CAPACITY,
    order: tuple[str, ...] = ("doc_id", "piece"),
    nodes: int = NODES,
) -> DataFrame:
    """Each row with ``sequence_id`` and its ``offset`` there, by its ``length``.

    Lengths lie between 1 and ``capacity``; others raise an error. Sequences have no gaps.
    All columns and rows stay, repeated ones too; columns named like the added ones are
    replaced. The input is stored first, since it is read more than once.
    """
    stored = cut_lineage(parts.drop("sequence_id", "offset"))
    n, least, most = stored.agg(F.count("*"), F.min("length"), F.max("length")).first()
    if n and not 1 <= least <= most <= capacity:
        raise ValueError(f"lengths must lie between 1 and {capacity}")
    chunks = math.ceil(math.sqrt(n)) or 1
    # The user's columns stay together, so that none is taken for one of those beside it.
    placed = stored.select(
        F.struct(*stored.columns).alias("kept"),
        F.struct(*order).alias("order"),
        F.col("length"),
        F.pmod(F.xxhash64(*order), F.lit(chunks)).cast("int").alias("chunk"),
    )
    sums = cut_lineage(placed.groupBy("length", "chunk").agg(F.count("*").alias("n")))
    counts = {r["length"]: r["n"] for r in sums.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots = _slots(complete(counts, capacity, nodes))
    earlier = W.partitionBy("length").orderBy("chunk").rowsBetween(W.unboundedPreceding, -1)
    starts = sums.select(
        "length", "chunk", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")
    )
    inside = W.partitionBy("length", "chunk").orderBy("order")
    ranked = (
        placed.withColumn("row", F.row_number().over(inside) - 1)
        .join(starts, ["length", "chunk"])
        .withColumn("rank", F.col("before") + F.col("row"))
    )
    keys = slots[:, 0] << 44 | slots[:, 1]

    @arrow_udf("struct<sequence_id: bigint, offset: bigint>")
    def slot(length: pa.Array, rank: pa.Array) -> pa.Array:
        size, place = length.to_numpy(), rank.to_numpy()
        row = slots[np.searchsorted(keys, size << 44 | place, side="right") - 1]
        nth = place - row[:, 1]
        return pa.StructArray.from_arrays(
            [
                pa.array(row[:, 3] + nth // row[:, 2]),
                pa.array(row[:, 4] + nth % row[:, 2] * size),
            ],
            ["sequence_id", "offset"],
        )

    found = ranked.withColumn("slot", slot(F.col("length").cast("bigint"), "rank"))
    return found.select("kept.*", "slot.sequence_id", "slot.offset")
