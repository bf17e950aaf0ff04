"""Score texts by prediction by partial matching over byte contexts, pretrained on a corpus.

The model is a trie of byte contexts up to ``ORDER`` long, kept as counts of grams: a
context and the byte after it. A byte is predicted from its longest context; if that
context was never followed by it, the model escapes to the next shorter one. Of the
bytes seen after a context, half a sighting of each distinct one is the escape's share
(method D), and bytes that a longer context has ruled out are excluded from the counts of
the shorter ones. After the empty context all bytes not yet seen share equally. A text
begins with marks that are no bytes of UTF-8, and its end is an event like a byte.

Since the trie is built before it is used, a gram has one code length, wherever it stands:

1. The texts are stored in blocks. Each block lists its distinct grams and words with their
   training counts; long texts go through in slices.
2. The lists are dealt by gram, so counts over the whole corpus and the join back to the
   blocks use one shuffle. Code lengths are worked out on the distinct grams, dealt by the
   two bytes before the predicted one, which fix all contexts but the two shortest; those
   have at most 65,536 grams, which go to every task.
3. Each block gets the code lengths of its own grams, and adds them up along its texts.

Words are looked up in the same way for the unigram base. Both tables grow with the corpus
and are never in one place; a block's share is bounded by the block.
"""

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, LongType, StructField, StructType

from staywise.llm.common import BLOCK, held_out, partitions, stored_in_blocks

ORDER = 5
SMOOTHING = 0.1
FOLDS = 10
#: Bytes that UTF-8 never has: before the text, and after it.
BEGIN, END = 0xFF, 0xFE
SYMBOLS = 255
_SLICE = 1 << 19
_FLUSH = 1 << 19
#: Distinct words held before a block's lists are sent on; what is sent twice adds up.
_WORDS = 1 << 20
_LISTS = StructType(
    [StructField("key", LongType(), False), StructField("slot", LongType(), False)]
)


def word_key(word: bytes) -> int:
    """A negative long, which no gram is; the empty word stands for the text's end."""
    return xxhash.xxh64_intdigest(word) // 2 - (1 << 63)


def gram_slices(text: bytes, order: int) -> Iterator[np.ndarray]:
    """The grams of a text, oldest byte highest, a slice at a time."""
    whole = bytes([BEGIN]) * order + text + bytes([END])
    for at in range(0, len(whole) - order, _SLICE):
        raw = np.frombuffer(whole, dtype=np.uint8)[at : at + _SLICE + order]
        n = len(raw) - order
        codes = np.zeros(n, dtype=np.int64)
        for k in range(order + 1):
            codes = (codes << 8) | raw[k : k + n]
        yield codes


def _merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    distinct, place = np.unique(np.concatenate(keys), return_inverse=True)
    return distinct, np.bincount(place, np.concatenate(counts), len(distinct)).astype(np.int64)


class _Lists:
    """Distinct keys of one block with their training counts; flushed when they are many."""

    def __init__(self, order: int):
        self.order = order
        self.limit = _FLUSH
        self.keys: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.words: tuple[Counter, Counter] = (Counter(), Counter())
        self.slices: dict[bool, list[np.ndarray]] = {False: [], True: []}
        self.sizes = {False: 0, True: 0}

    def _close(self, training: bool) -> None:
        if self.slices[training]:
            keys, counts = np.unique(np.concatenate(self.slices[training]), return_counts=True)
            self.keys.append(keys)
            self.counts.append(counts if training else np.zeros_like(counts))
            self.slices[training], self.sizes[training] = [], 0
        if sum(map(len, self.keys)) > self.limit:
            keys, counts = _merged(self.keys, self.counts)
            self.keys, self.counts = [keys], [counts]
            # Twice what is distinct, so that merging stays in proportion to the text.
            self.limit = max(_FLUSH, 2 * len(keys))

    def add(self, text: bytes, training: bool) -> None:
        for codes in gram_slices(text, self.order):
            self.slices[training].append(codes)
            self.sizes[training] += len(codes)
            if self.sizes[training] >= 2 * _SLICE:
                self._close(training)
        words = self.words[training]
        words.update(text.split())
        words[b""] += 1

    def full(self) -> bool:
        return sum(map(len, self.words)) > _WORDS

    def rows(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for training in (False, True):
            self._close(training)
            words = self.words[training]
            if words:
                self.keys.append(np.fromiter(map(word_key, words), np.int64, len(words)))
                counts = np.fromiter(words.values(), np.int64, len(words))
                self.counts.append(counts if training else counts * 0)
        if self.keys:
            yield _merged(self.keys, self.counts)
        self.__init__(self.order)


def _text(value: pa.Scalar) -> bytes:
    return bytes(value.as_buffer()).lower() if value.is_valid else b""


def _lists(order: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists, block = _Lists(order), None

        def emit():
            for keys, counts in lists.rows():
                for at in range(0, len(keys), _FLUSH):
                    part = slice(at, at + _FLUSH)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keys[part]), pa.array(counts[part] | block << BLOCK)],
                        ["key", "slot"],
                    )

        for batch in batches:
            for own, held, text in zip(
                batch.column("block").to_pylist(),
                batch.column("held_out").to_pylist(),
                batch.column("text"),
                strict=True,
            ):
                if block is not None and (own != block or lists.full()):
                    yield from emit()
                block = own
                lists.add(_text(text), not held)
        if block is not None:
            yield from emit()

    return task


@dataclass(frozen=True)
class _Level:
    """Grams of one order: sorted codes with counts, and their contexts' totals."""

    codes: np.ndarray
    counts: np.ndarray
    contexts: np.ndarray
    totals: np.ndarray
    distinct: np.ndarray

    @staticmethod
    def of(codes: np.ndarray, counts: np.ndarray) -> "_Level":
        """From the grams of the same or a higher order, cut to this one; zeros drop out."""
        codes, place = np.unique(codes, return_inverse=True)
        counts = np.bincount(place, counts, len(codes)).astype(np.int64)
        codes, counts = codes[counts > 0], counts[counts > 0]
        contexts, place = np.unique(codes >> 8, return_inverse=True)
        totals = np.bincount(place, counts, len(contexts)).astype(np.int64)
        return _Level(codes, counts, contexts, totals, np.bincount(place, minlength=len(contexts)))

    def _at(self, sought: np.ndarray, held: np.ndarray, values: np.ndarray) -> np.ndarray:
        if not len(held):
            return np.zeros(len(sought), dtype=np.int64)
        place = np.minimum(np.searchsorted(held, sought), len(held) - 1)
        return np.where(held[place] == sought, values[place], 0)

    def count(self, codes: np.ndarray) -> np.ndarray:
        return self._at(codes, self.codes, self.counts)

    def total(self, codes: np.ndarray) -> np.ndarray:
        return self._at(codes >> 8, self.contexts, self.totals)

    def kinds(self, codes: np.ndarray) -> np.ndarray:
        return self._at(codes >> 8, self.contexts, self.distinct)

    def mass_below(self, lower: "_Level", order: int, codes: np.ndarray) -> np.ndarray:
        """Of each gram's context, the count one order below of the bytes seen after it."""
        shorter = lower.count(self.codes & ((1 << 8 * order) - 1))
        _, place = np.unique(self.codes >> 8, return_inverse=True)
        mass = np.bincount(place, shorter, len(self.contexts)).astype(np.int64)
        return self._at(codes >> 8, self.contexts, mass)


def log_probabilities(codes: np.ndarray, levels: list[_Level]) -> np.ndarray:
    """Base-10 logarithm of each gram's last byte given the others; levels by order."""
    result = np.zeros(len(codes))
    open_ = np.ones(len(codes), dtype=bool)
    out_mass = np.zeros(len(codes), dtype=np.int64)
    out_kinds = np.zeros(len(codes), dtype=np.int64)
    for order in range(len(levels) - 1, -1, -1):
        level = levels[order]
        cut = codes & ((1 << 8 * (order + 1)) - 1)
        count, kinds = level.count(cut), level.kinds(cut)
        # Half a count of each byte's first sighting goes to the escape.
        base = 2 * (level.total(cut) - out_mass)
        escape = kinds - out_kinds
        hit = open_ & (count > 0)
        miss = open_ & (count == 0) & (base > 0)
        result[hit] += np.log10((2 * count[hit] - 1) / base[hit])
        result[miss] += np.log10(escape[miss] / base[miss])
        open_ &= ~hit
        if order:
            out_mass = level.mass_below(levels[order - 1], order, cut)
        out_kinds = kinds
    result[open_] -= np.log10(np.maximum(SYMBOLS - out_kinds[open_], 1))
    return result


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of the byte pairs of some training texts."""
    total = np.zeros(1 << 16, dtype=np.int64)
    for batch in batches:
        for text in batch.column("text"):
            for codes in gram_slices(_text(text), 1):
                total += np.bincount(codes, minlength=1 << 16)
    seen = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["pair", "n"])


def _values(order: int, short: _Level, empty: _Level):
    """Code lengths of all grams of some pairs of last context bytes; words keep counts."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = [b for b in batches if b.num_rows]
        if not tables:
            return
        keys = np.concatenate([b.column("key").to_numpy() for b in tables])
        counts = np.concatenate([b.column("n").to_numpy() for b in tables])
        gram = keys >= 0
        codes, levels = keys[gram], [empty, short]
        for k in range(2, order + 1):
            levels.append(_Level.of(codes & ((1 << 8 * (k + 1)) - 1), counts[gram]))
        values = counts.astype(np.float64)
        values[gram] = log_probabilities(codes, levels)
        for at in range(0, len(keys), _FLUSH):
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[at : at + _FLUSH]), pa.array(values[at : at + _FLUSH])],
                ["key", "value"],
            )

    return task


class Lookup:
    """Values by key, in a hash table that takes little more room than the two columns.

    Keys may repeat with the same value.
    """

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.keys, self.values = keys, values
        bits = max(4, int(2 * len(keys)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), np.int64((1 << bits) - 1)
        self.slots = np.full(1 << bits, -1, dtype=np.int32)
        open_ = np.arange(len(keys), dtype=np.int32)
        slot = self._slots(keys)
        while len(open_):
            free = self.slots[slot] < 0
            self.slots[slot[free]] = open_[free]
            left = keys[self.slots[slot]] != keys[open_]
            open_, slot = open_[left], (slot[left] + 1) & self.mask

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        spread = keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (spread >> self.shift).astype(np.int64)

    def of(self, keys: np.ndarray) -> np.ndarray:
        """The values of keys that are all there."""
        slot = self._slots(keys)
        found = self.slots[slot]
        missed = np.flatnonzero(self.keys[found] != keys)
        while len(missed):
            slot[missed] = (slot[missed] + 1) & self.mask
            found[missed] = self.slots[slot[missed]]
            if (found[missed] < 0).any():
                raise KeyError("a gram or word without a value")
            missed = missed[self.keys[found[missed]] != keys[missed]]
        return self.values[found]


def _scores(order: int, smoothing: float):
    def score(docs: pa.Table, values: pa.Table) -> pa.Table:
        known = Lookup(values.column("key").to_numpy(), values.column("value").to_numpy())
        ends = word_key(b"")
        rows = []
        for text in docs.column("text").combine_chunks():
            raw = _text(text)
            bits = sum(float(known.of(codes).sum()) for codes in gram_slices(raw, order))
            words = raw.split()
            sought = np.fromiter((word_key(w) for w in words), np.int64, len(words))
            counts = known.of(np.append(sought, ends))
            base = float(np.log10(counts + smoothing).sum())
            rows.append((len(counts), int((counts > 0).sum()), base, bits))
        tokens, known, base, bits = zip(*rows, strict=True)
        return pa.table(
            {
                "doc_id": docs.column("doc_id"),
                "held_out": docs.column("held_out").combine_chunks(),
                "n_tokens": pa.array(tokens, pa.int64()),
                "n_known": pa.array(known, pa.int64()),
                "base": pa.array(base, pa.float64()),
                "score": pa.array(bits, pa.float64()),
            }
        )

    return score


def score(
    docs: DataFrame,
    folds: int = FOLDS,
    order: int = ORDER,
    smoothing: float = SMOOTHING,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per document: its key, ``held_out``, word counts, ``base_score``, ``score``.

    Both models learn from rows outside the held-out fold, of whole texts with A-Z in lower
    case. ``score`` is the base-10 logarithm of the text's probability, its end included;
    ``base_score`` is that of its words under smoothed unigrams. Null texts are empty. Every
    row counts, repeated ones and null keys too. Orders from 2 to 6.

    Words are told apart by a hash of 63 bits.
    """
    if not 2 <= order <= 6:
        raise ValueError("contexts of 2 to 6 bytes only")
    spark = docs.sparkSession
    stored = stored_in_blocks(
        docs.select(
            F.col(doc_id).alias("doc_id"),
            held_out(F.col(doc_id), folds).alias("held_out"),
            F.col(text).cast("string").alias("text"),
        )
    )
    counted = (
        stored.where(~F.col("held_out"))
        .select("text")
        .mapInArrow(_pairs, "pair bigint, n bigint")
        .groupBy("pair")
        .agg(F.sum("n").alias("n"))
    )
    # At most 65,536 rows, one per pair of bytes.
    short = np.array([tuple(r) for r in counted.collect()], dtype=np.int64).reshape(-1, 2)
    levels = [_Level.of(short[:, 0] & 0xFF, short[:, 1]), _Level.of(short[:, 0], short[:, 1])]

    # Both columns are needed wherever this is read, so all readers share its one shuffle.
    dealt = stored.mapInArrow(_lists(order), _LISTS).repartition(partitions(spark), "key")
    count = F.sum(F.col("slot").bitwiseAND(F.lit((1 << BLOCK) - 1)))
    counts = dealt.groupBy("key").agg(count.alias("n"))
    pair = F.shiftright("key", 8).bitwiseAND(F.lit(0xFFFF))
    values = counts.repartition(
        partitions(spark), F.when(F.col("key") < 0, F.xxhash64("key")).otherwise(pair)
    ).mapInArrow(_values(order, levels[1], levels[0]), "key bigint, value double")
    placed = dealt.join(values, "key").select(
        F.shiftright("slot", BLOCK).alias("block"), "key", "value"
    )
    word = F.col("key") < 0
    figures = counts.agg(
        F.struct(
            F.coalesce(F.sum(F.when(word, F.col("n"))), F.lit(0)).alias("total"),
            F.count_if(word & (F.col("n") > 0)).alias("distinct"),
        ).alias("figures")
    ).scalar()
    fields = [
        stored.schema["doc_id"],
        StructField("held_out", BooleanType()),
        *[StructField(name, LongType()) for name in ("n_tokens", "n_known")],
        *[StructField(name, DoubleType()) for name in ("base", "score")],
    ]
    scored = (
        stored.groupBy("block")
        .cogroup(placed.groupBy("block"))
        .applyInArrow(_scores(order, smoothing), StructType(fields))
    )
    total = figures["total"]
    floor = F.log10(total + smoothing * (figures["distinct"] + 1))
    return scored.select(
        "doc_id",
        "held_out",
        "n_tokens",
        "n_known",
        total.alias("train_tokens"),
        (F.col("base") - F.col("n_tokens") * floor).alias("base_score"),
        "score",
    )
