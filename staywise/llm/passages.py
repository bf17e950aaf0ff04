"""Remove passages that recur, located by automata of repeated phrases.

A window of ``window`` words recurs if its words also start anywhere else. Every window
holds a phrase of ``phrase`` words that its own words choose, the one with the least hash,
so equal windows choose equal phrases and can be sought by phrase. Neighbouring windows
mostly choose the same phrase; such a run of windows is handled as one.

1. Texts are stored in blocks of bounded size. Each block lists its runs, by phrase and by
   the run's words. Added up over all blocks, the lists show which phrases recur, which runs
   recur whole, and which phrases have runs that do not.
2. Recurring phrases are confirmed: one block that has a phrase spells its words, and the
   windows of runs that do not recur whole are listed and counted one by one.
3. The phrases that occur in a block come to it as text, are compiled into automata, in
   shards of bounded size, and the block's documents are streamed through each. Every
   occurrence is where an automaton reports it; there the windows of a recurring run, and
   single windows that recur, are marked, and covered words are dropped.

An automaton holds the phrases of one block only, so automata grow with a block, not with
the corpus, and every document meets all phrases that can occur in it. Phrases are matched
word by word; that a run or a window around one recurs rests on 128 bits, the hash of its
phrase and its own.
"""

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from staywise.llm.common import cut_lineage, stored_in_even_blocks

WINDOW = 35
PHRASE = 12
#: Phrases in one automaton.
SHARD = 1 << 14
#: Bytes of text in a block.
BLOCK = 1 << 22
_SLICE = 1 << 18
_FLUSH = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
#: Bits for a place in a slice, which has fewer words.
_PLACE = np.uint64((1 << 24) - 1)
#: Letters that spell a word.
_DIGITS = 4
#: Whether something occurs once or more is all that is counted: two bits beside a block.
_ONCE, _COUNT = 2, 3
_SPELL, _MIXED = 0, 1
_PHRASE_KIND, _RUN_KIND, _WINDOW_KIND = 0, 1, 2


def _longs(*names: str) -> StructType:
    return StructType([StructField(name, LongType(), False) for name in names])


def _mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Vocabulary(dict):
    """Numbers and hashes of the words met so far."""

    def __init__(self):
        super().__init__()
        self.hashes: list[int] = []
        self._array = np.empty(0, dtype=np.uint64)

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self.hashes)
        self.hashes.append(xxhash.xxh64_intdigest(word))
        return number

    def array(self) -> np.ndarray:
        """The hashes by number."""
        known = len(self._array)
        if known < len(self.hashes):
            more = np.array(self.hashes[known:], dtype=np.uint64)
            self._array = np.append(self._array, more)
        return self._array

    def numbers(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int32, len(words))


def _words_met(held: dict) -> Vocabulary:
    """The vocabulary of a task's blocks, which share most of their words, while it is short."""
    if len(held.get("words", ())) > _FLUSH:
        del held["words"]
    return held.setdefault("words", Vocabulary())


class Powers:
    """Powers of the base and of its inverse, computed once for slices of any size."""

    def __init__(self):
        self.base = self.inverse = np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.base) <= n:
            self.base, self.inverse = (
                np.cumprod(np.append(np.uint64(1), np.full(n, step)))
                for step in (_BASE, _INVERSE)
            )
        return self.base[:n], self.inverse


class Slice:
    """Some documents' words, or a slice of one's, with their windows and runs.

    ``lo``, ``hi`` and ``at`` are each run's first and last window and its phrase's place.
    """

    def __init__(
        self,
        numbers: np.ndarray,
        ends: np.ndarray,
        hashes: np.ndarray,
        window: int,
        phrase: int,
        powers: Powers,
    ):
        n = len(numbers)
        self.numbers, self.window, self.phrase = numbers, window, phrase
        base, self._inverse = powers.upto(n + 1)
        self._sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(hashes[numbers] * base[:n], out=self._sums[1:])
        starts = np.append(0, ends[:-1])
        until = np.repeat(ends, ends - starts)
        places = np.arange(n)
        valid = places + window <= until
        self.lo = self.hi = self.at = np.empty(0, dtype=np.int64)
        if not valid.any():
            return
        # Phrases that run past their document belong to no valid window. A phrase's place
        # takes its hash's low bits, so that of equal ones the first is the least.
        least = (self.hash(places, np.minimum(places + phrase, n)) & ~_PLACE) | places.astype(
            np.uint64
        )
        width, options = 1, window - phrase + 1
        while width < options:
            step = min(width, options - width)
            least = np.minimum(least[:-step], least[step:])
            width += step
        windows = np.flatnonzero(valid[: len(least)])
        chosen = (least[windows] & _PLACE).astype(np.int64)
        new = np.ones(len(windows), dtype=bool)
        new[1:] = (np.diff(chosen) != 0) | (np.diff(windows) != 1)
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(windows)) - 1
        self.lo, self.hi, self.at = windows[first], windows[last], chosen[first]

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mixed((self._sums[end] - self._sums[start]) * self._inverse[start])

    def phrases(self) -> np.ndarray:
        return self.hash(self.at, self.at + self.phrase)

    def runs(self) -> np.ndarray:
        """Hash of a run's words and of where its phrase lies among them."""
        words = self.hash(self.lo, self.hi + self.window)
        place = (self.at - self.lo).astype(np.uint64) << np.uint64(32)
        return _mixed(words ^ _mixed(place | (self.hi - self.lo).astype(np.uint64)))

    def windows(self, start: np.ndarray) -> np.ndarray:
        return self.hash(start, start + self.window)


def _slices(
    texts: pa.Array | pa.ChunkedArray, vocabulary: Vocabulary, window: int, phrase: int
) -> Iterator[tuple[Slice, list[tuple[int, int, int]]]]:
    """Slices of about a bounded number of words, with (text, first word, words) of each
    part. A long text is cut into parts that overlap by less than a window, so each of its
    windows is in one part."""
    numbers, ends, parts, powers = [], [0], [], Powers()

    def made():
        joined = np.concatenate(numbers)
        return Slice(joined, np.array(ends[1:]), vocabulary.array(), window, phrase, powers), parts

    for k, text in enumerate(texts):
        found = bytes(text.as_buffer()).split() if text.is_valid else []
        if len(found) < window:
            continue
        own = vocabulary.numbers(found)
        for at in range(0, len(own) - window + 1, _SLICE):
            part = own[at : at + _SLICE + window - 1]
            numbers.append(part)
            ends.append(ends[-1] + len(part))
            parts.append((k, at, len(part)))
            if ends[-1] >= _SLICE:
                yield made()
                numbers, ends, parts = [], [0], []
    if parts:
        yield made()


def _list_runs(window: int, phrase: int):
    """Each block's distinct runs with their number, below the block's own number."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        block, vocabulary = None, Vocabulary()

        def emit():
            if not held:
                return
            runs = np.concatenate([r for _, r in held])
            phrases = np.concatenate([p for p, _ in held])
            runs, first, counts = np.unique(runs, return_index=True, return_counts=True)
            held.clear()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(phrases[first].view(np.int64)),
                    pa.array(runs.view(np.int64)),
                    pa.array(np.minimum(counts, _COUNT) | block << _ONCE),
                ],
                ["phrase", "run", "slot"],
            )

        for batch in batches:
            blocks = batch.column("block").to_numpy()
            cuts = np.append(np.flatnonzero(np.diff(blocks)) + 1, len(blocks))
            begin = 0
            for cut in cuts:
                own = int(blocks[begin])
                if own != block or sum(len(p) for p, _ in held) > 4 * _FLUSH:
                    yield from emit()
                    block = own
                texts = batch.column("text").slice(begin, cut - begin)
                for piece, _ in _slices(texts, vocabulary, window, phrase):
                    held.append((piece.phrases(), piece.runs()))
                if len(vocabulary) > _FLUSH:
                    vocabulary = Vocabulary()
                begin = cut
        yield from emit()

    return task


def _spelled(numbers: np.ndarray, letters: int) -> str:
    """Each word's number as ``_DIGITS`` letters, another alphabet for each place, so that a
    match starts and ends with a word and no node of a trie has many children."""
    spelled = np.empty((len(numbers), _DIGITS), dtype="<u2")
    for place in range(_DIGITS):
        spelled[:, place] = numbers // letters**place % letters + letters * place + 256
    return spelled.tobytes().decode("utf-16-le")


def _automata(phrases: list[str], shard: int) -> Iterator[ahocorasick.Automaton]:
    """The phrases compiled, one shard at a time."""
    for at in range(0, len(phrases), shard):
        automaton = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
        for phrase in phrases[at : at + shard]:
            automaton.add_word(phrase)
        automaton.make_automaton()
        yield automaton


def occurrences(
    pieces: list[Slice], vocabulary: Vocabulary, phrases: list[bytes], shard: int
) -> list[np.ndarray]:
    """For each piece, which of its places a phrase starts at, as the automata report it.

    ``phrases`` are words joined by spaces; all pieces are streamed through each shard.
    """
    letters = 2
    while letters**_DIGITS < len(vocabulary):
        letters += 1
    # A phrase with a word that no document of the block has occurs nowhere in it.
    split = [words for words in (p.split(b" ") for p in phrases) if vocabulary.keys() >= set(words)]
    size = len(split[0]) if split else 0
    numbers = np.fromiter((vocabulary[w] for words in split for w in words), np.int64)
    spelled = _spelled(numbers, letters)
    wide = size * _DIGITS
    sought = [spelled[k * wide : (k + 1) * wide] for k in range(len(split))]
    texts = [_spelled(piece.numbers, letters) for piece in pieces]
    met = [np.zeros(len(piece.numbers), dtype=bool) for piece in pieces]
    for automaton in _automata(sought, shard):
        for text, places in zip(texts, met, strict=True):
            ends = np.fromiter((end for end, _ in automaton.iter(text)), np.int64)
            places[(ends + 1) // _DIGITS - size] = True
    return met


def _keys(table: pa.Table, kind: int) -> np.ndarray:
    chosen = table.column("kind").to_numpy() == kind
    return np.unique(table.column("key").to_numpy()[chosen].view(np.uint64))


def _confirm(window: int, phrase: int):
    """The words of phrases to spell, and the windows of all runs around mixed phrases."""

    held: dict = {}

    def task(docs: pa.Table, given: pa.Table) -> pa.Table:
        spelled: dict[int, bytes] = {}
        phrases, windows, block = [], [], 0
        if docs.num_rows and given.num_rows:
            block = docs.column("block")[0].as_py()
            spell, mixed = _keys(given, _SPELL), _keys(given, _MIXED)
            vocabulary = _words_met(held)
            pieces = [p for p, _ in _slices(docs.column("text"), vocabulary, window, phrase)]
            words = list(vocabulary)
            for piece in pieces:
                keys = piece.phrases()
                own, first = np.unique(keys, return_index=True)
                for k in np.flatnonzero(np.isin(own, spell)):
                    if int(own[k]) not in spelled:
                        at = piece.at[first[k]]
                        spelled[int(own[k])] = b" ".join(
                            words[n] for n in piece.numbers[at : at + phrase]
                        )
                at = np.flatnonzero(np.isin(keys, mixed))
                sizes = piece.hi[at] - piece.lo[at] + 1
                start = np.repeat(piece.lo[at] - np.append(0, np.cumsum(sizes)[:-1]), sizes)
                windows.append(piece.windows(start + np.arange(len(start))))
                phrases.append(np.repeat(keys[at], sizes))
        none = np.empty(0, dtype=np.uint64)
        found, first, counts = np.unique(
            np.concatenate([*windows, none]), return_index=True, return_counts=True
        )
        owners = np.concatenate([*phrases, none])[first]
        n = len(spelled)
        return pa.table(
            {
                "phrase": np.concatenate([np.array(list(spelled), dtype=np.uint64), owners]).view(np.int64),
                "words": pa.array([*spelled.values(), *[None] * len(found)], pa.binary()),
                "window": np.concatenate([np.zeros(n, np.int64), found.view(np.int64)]),
                "slot": np.concatenate(
                    [np.zeros(n, np.int64), np.minimum(counts, _COUNT) | block << _ONCE]
                ),
            }
        )

    return task


def _drop(window: int, phrase: int, shard: int):
    """Each document without the words that recurring windows cover."""

    held: dict = {}

    def marked(texts, phrases, runs, single) -> dict[int, np.ndarray]:
        """By document, which of its words recurring windows cover."""
        marks: dict[int, np.ndarray] = {}
        vocabulary = _words_met(held)
        sliced = list(_slices(texts, vocabulary, window, phrase))
        met = occurrences([piece for piece, _ in sliced], vocabulary, phrases, shard)
        for (piece, parts), places in zip(sliced, met, strict=True):
            at = np.flatnonzero(places[piece.at])
            whole = np.isin(piece.runs()[at], runs)
            edge = np.zeros(len(piece.numbers) + 1, dtype=np.int64)
            np.add.at(edge, piece.lo[at][whole], 1)
            np.add.at(edge, piece.hi[at][whole] + window, -1)
            rest = at[~whole]
            sizes = piece.hi[rest] - piece.lo[rest] + 1
            first = np.repeat(piece.lo[rest] - np.append(0, np.cumsum(sizes)[:-1]), sizes)
            starts = first + np.arange(len(first))
            starts = starts[np.isin(piece.windows(starts), single)]
            np.add.at(edge, starts, 1)
            np.add.at(edge, starts + window, -1)
            covered = np.cumsum(edge)[:-1] > 0
            begin = 0
            for k, offset, n in parts:
                own = covered[begin : begin + n]
                begin += n
                if own.any():
                    mark = marks.setdefault(k, np.zeros(offset + n, dtype=bool))
                    if len(mark) < offset + n:
                        mark = marks[k] = np.append(mark, np.zeros(offset + n - len(mark), bool))
                    mark[offset : offset + n] |= own
        return marks

    def task(docs: pa.Table, given: pa.Table) -> pa.Table:
        texts = docs.column("text")
        marks: dict[int, np.ndarray] = {}
        chosen = given.column("kind").to_numpy() == _PHRASE_KIND
        phrases = given.column("words").filter(pa.array(chosen)).to_pylist()
        if phrases:
            runs, single = (_keys(given, kind) for kind in (_RUN_KIND, _WINDOW_KIND))
            marks = marked(texts, phrases, runs, single)
        counts, removed, kept = [], [], []
        for k, text in enumerate(texts):
            found = bytes(text.as_buffer()).split() if text.is_valid else []
            gone = 0
            counts.append(len(found))
            if k in marks:
                gone = int(marks[k].sum())
                stay = np.append(~marks[k], np.ones(len(found) - len(marks[k]), dtype=bool))
                found = [found[i] for i in np.flatnonzero(stay)]
            removed.append(gone)
            kept.append(b" ".join(found))
        texts = pa.array(kept, pa.binary())
        del kept
        return pa.table(
            {
                "doc_id": docs.column("doc_id"),
                "n_words": pa.array(counts, pa.int64()),
                "n_removed": pa.array(removed, pa.int64()),
                "kept": texts.cast(pa.string()),
            }
        )

    return task


def drop_repeats(
    docs: DataFrame,
    window: int = WINDOW,
    phrase: int = PHRASE,
    shard: int = SHARD,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per document: its key, ``n_words``, ``n_removed``, and the text ``kept``.

    A word goes if a window of ``window`` words around it also starts elsewhere, in any
    document; all windows are judged on the input. Kept words are joined by one space. Texts
    that are null or shorter than a window keep what they have, null as empty. Repeated rows
    repeat each other's windows. ``phrase`` is at most ``window``.
    """
    if not 1 <= phrase <= window:
        raise ValueError("a phrase lies within a window")
    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    stored = stored_in_even_blocks(narrow, "text", BLOCK)
    count = F.sum(F.col("slot").bitwiseAND(_COUNT))
    block = F.shiftright("slot", _ONCE).alias("block")

    # Read twice: to count phrases, and for the rows of those that recur.
    dealt = cut_lineage(
        stored.mapInArrow(_list_runs(window, phrase), _longs("phrase", "run", "slot"))
    )
    again = dealt.groupBy("phrase").agg(count.alias("n")).where("n > 1").select("phrase")
    recurring = cut_lineage(dealt.join(again, "phrase").select("phrase", "run", "slot"))
    runs = recurring.groupBy("phrase", "run").agg(count.alias("n"))
    phrases = recurring.groupBy("phrase").agg(F.min(block).alias("home")).join(
        runs.groupBy("phrase").agg((F.min("n") == 1).alias("mixed")), "phrase"
    )
    judged = runs.join(phrases, "phrase").select(
        "phrase", "run", (F.col("n") > 1).alias("whole"), "mixed", "home"
    )
    found = cut_lineage(
        recurring.join(judged, ["phrase", "run"]).select(
            block, "phrase", "run", "whole", "mixed", "home"
        )
    )

    def keyed(rows: DataFrame, kind: int, key: str, words=None) -> DataFrame:
        words = F.lit(None).cast("binary") if words is None else F.col(words)
        return rows.select(
            "block", F.lit(kind).alias("kind"), F.col(key).alias("key"), words.alias("words")
        )

    asked = keyed(found.where("block = home"), _SPELL, "phrase").unionByName(
        keyed(found.where("mixed"), _MIXED, "phrase")
    ).distinct()
    confirmed = cut_lineage(
        stored.groupBy("block")
        .cogroup(asked.groupBy("block"))
        .applyInArrow(
            _confirm(window, phrase),
            StructType([
                StructField("phrase", LongType()), StructField("words", BinaryType()),
                StructField("window", LongType()), StructField("slot", LongType()),
            ]),
        )
    )
    windows = confirmed.where("words is null")
    more = windows.groupBy("phrase", "window").agg(count.alias("n")).where("n > 1").drop("n")
    single = windows.join(more, ["phrase", "window"]).select(block, "window")
    spelled = confirmed.where("words is not null").select("phrase", "words")
    texts = found.select("block", "phrase").distinct().join(spelled, "phrase")
    given = (
        keyed(texts, _PHRASE_KIND, "phrase", "words")
        .unionByName(keyed(found.where("whole"), _RUN_KIND, "run"))
        .unionByName(keyed(single, _WINDOW_KIND, "window"))
    )
    fields = [stored.schema["doc_id"], StructField("n_words", LongType()), StructField("n_removed", LongType())]
    return (
        stored.groupBy("block")
        .cogroup(given.groupBy("block"))
        .applyInArrow(
            _drop(window, phrase, shard),
            StructType([*fields, StructField("kept", StringType())]),
        )
    )
