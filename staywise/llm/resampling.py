"""Importance resampling towards a target distribution of word n-grams.

Texts and target are bags of hashed runs of one to three words. A bucket's gain is the log
ratio of its share in the target to that in the corpus; a document weighs the sum of gains
of its features, gets Gumbel noise from its key, and the highest scores are drawn.

A batch's texts are joined with a sentinel byte after each, one pass of a regular expression
finds all words and sentinels, the documents' offsets are searched for every word, and
n-grams that would cross from one document to the next are masked before buckets are
counted. The checksum of an n-gram is put together from those of its words, so no n-gram is
ever spelled out.
"""

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import LongType, StructField, StructType

from staywise.llm.common import cut_lineage
from staywise.operators.running import numbered

BUCKETS = 10_000
WIDTH = 3
SEED = 42
LEAST_WORDS = 20
PERCENT = 5
ADDED = ("n_features", "weight", "score", "rank")

#: Bytes joined at once; a longer text is cut between words.
CHUNK = 1 << 22
#: Words remembered with their checksums.
KNOWN = 1 << 18

_SENTINEL = b"\x00"
#: Lower case, and no sentinel inside a text.
_FOLD = bytes(32 if b == 0 else b + 32 if 65 <= b <= 90 else b for b in range(256))
_WORDS = re.compile(rb"[0-9a-z\x80-\xff]+|\x00")
_GAP = re.compile(rb"[^0-9a-z\x80-\xff]")

_FIRST = 64


def _one_byte_on(crc: np.ndarray) -> np.ndarray:
    """Checksums as they are after one more zero byte, but for the inversions."""
    for _ in range(8):
        crc = np.where(crc & 1, (crc >> 1) ^ np.uint32(0xEDB88320), crc >> 1)
    return crc


def _moved(crc: np.ndarray, tables: np.ndarray, at) -> np.ndarray:
    """Apply to each checksum the table that ``at`` names, byte by byte."""
    moved = tables[at, 0, crc & 255]
    for k in range(1, 4):
        moved = moved ^ tables[at, k, (crc >> np.uint32(8 * k)) & 255]
    return moved


class _Shift:
    """Checksums moved on by a number of bytes: directly below ``_FIRST``, beyond by halves."""

    def __init__(self):
        same = np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]
        tables = [same]
        for _ in range(_FIRST):
            tables.append(_one_byte_on(tables[-1]))
        self.near = np.stack(tables[:_FIRST])
        self.far = [tables[_FIRST][None]]

    def __call__(self, crc: np.ndarray, size: np.ndarray) -> np.ndarray:
        crc = _moved(crc, self.near, size % _FIRST)
        rest, step = size // _FIRST, 0
        while rest.any():
            if step == len(self.far):
                last = self.far[-1]
                self.far.append(_moved(last[0], last, 0)[None])
            odd = np.flatnonzero(rest & 1)
            crc[odd] = _moved(crc[odd], self.far[step], 0)
            rest, step = rest >> 1, step + 1
        return crc


class _Words(dict):
    """A number for each word, with its checksum, alone and after a space, and its length."""

    def __init__(self):
        super().__init__()
        self.alone, self.after, self.size = [], [], []
        self[_SENTINEL]

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self.size)
        self.alone.append(zlib.crc32(word))
        self.after.append(zlib.crc32(b" " + word))
        self.size.append(len(word) + 1)
        return number


def _chunks(texts: Iterator[bytes], limit: int) -> Iterator[tuple[bytes, int, bool]]:
    """(joined texts, documents that end in them, whether the first began before)."""
    held: list[bytes] = []
    size = 0
    for text in texts:
        if held and size + len(text) > limit:
            yield b"".join(held), len(held), False
            held, size = [], 0
        if len(text) <= limit:
            held.append(text.translate(_FOLD) + _SENTINEL)
            size += len(text) + 1
            continue
        folded, begin, later = text.translate(_FOLD), 0, False
        while len(folded) - begin > limit and (gap := _GAP.search(folded, begin + limit)):
            yield folded[begin : gap.end()], 0, later
            begin, later = gap.end(), True
        yield folded[begin:] + _SENTINEL, 1, later
    if held:
        yield b"".join(held), len(held), False


class Features:
    """Buckets of the word n-grams of many texts, a chunk at a time."""

    def __init__(self, buckets: int = BUCKETS, width: int = WIDTH, chunk: int = CHUNK):
        self.buckets, self.width, self.chunk = buckets, width, chunk
        self.shift, self.words = _Shift(), _Words()

    def __call__(self, texts: Iterator[bytes]) -> Iterator[tuple[int, int, np.ndarray, list]]:
        """(first document, documents, words in each, [(buckets, documents) for 1, 2, ... words]).

        A document that is cut comes in several of these. Documents count from the first.
        """
        tail: list[bytes] = []
        first = 0
        for joined, ended, later in _chunks(texts, self.chunk):
            found = _WORDS.findall(joined)
            carried = tail if later else []
            n = max(ended, 1)
            if len(self.words) > KNOWN:
                self.words = _Words()
            numbers = np.fromiter(
                map(self.words.__getitem__, carried + found), np.int64, len(carried) + len(found)
            )
            ends = np.flatnonzero(numbers == 0)
            # Words before each document's end.
            ends -= np.arange(len(ends))
            numbers = numbers[numbers != 0]
            docs = np.searchsorted(ends, np.arange(len(numbers)), side="right")
            counts = np.bincount(docs[len(carried) :], minlength=n)
            yield first, n, counts, self._grams(numbers, docs, len(carried))
            tail = [w for w in found[-self.width :] if w != _SENTINEL]
            tail = (carried + tail)[max(0, len(carried) + len(tail) - self.width + 1) :]
            first += ended

    def _grams(self, numbers: np.ndarray, docs: np.ndarray, carried: int) -> list:
        """Buckets and documents of the runs that end at a word that was not carried."""
        alone = np.array(self.words.alone, dtype=np.uint32)[numbers]
        after = np.array(self.words.after, dtype=np.uint32)[numbers]
        size = np.array(self.words.size, dtype=np.int64)[numbers]
        crc, grams = alone, []
        for k in range(self.width):
            if k:
                crc = self.shift(crc[:-1], size[k:]) ^ after[k:]
            last = np.arange(k, len(numbers))
            inside = (docs[k:] == docs[: len(numbers) - k]) & (last >= carried)
            grams.append(((crc[inside] % self.buckets).astype(np.int64), docs[k:][inside]))
            if len(crc) <= 1:
                break
        return grams


def _bytes(texts: pa.Array) -> Iterator[bytes]:
    return (t.as_buffer().to_pybytes() if t.is_valid else b"" for t in texts)


def bucket_counts(docs: DataFrame, text: str = "text", buckets: int = BUCKETS, width: int = WIDTH):
    """``bucket, n``: features of all texts. A task emits each bucket at most once."""

    def count(batches):
        features = Features(buckets, width)
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for _, _, _, grams in features(_bytes(batch.column(0))):
                for found, _ in grams:
                    total += np.bincount(found, minlength=buckets)
        hit = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(hit.astype(np.int32)), pa.array(total[hit])], ["bucket", "n"]
        )

    rows = docs.select(F.col(text).cast("string")).mapInArrow(count, "bucket int, n bigint")
    return rows.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Each bucket's gain in thousandths, from the two tables of counts."""
    sides = []
    for counted in (corpus, target):
        side = np.zeros(buckets, dtype=np.int64)
        # At most one row a bucket.
        for bucket, n in counted.collect():
            side[bucket] = n
        sides.append(side)
    s, t = (side.tolist() for side in sides)
    of_s, of_t = float(sum(s) + buckets), float(sum(t) + buckets)
    return np.array([
        math.floor(1000 * math.log((float(b + 1) * of_s) / (float(a + 1) * of_t)))
        for a, b in zip(s, t, strict=True)
    ], dtype=np.int64)


def _weighed(gain: np.ndarray, width: int):
    kind = StructType([
        StructField(name, LongType()) for name in ("n_words", "n_features", "weight")
    ])
    made: dict[str, Features] = {}

    @arrow_udf(kind)
    def weigh(texts: pa.Array) -> pa.Array:
        features = made.setdefault("features", Features(len(gain), width))
        out = np.zeros((3, len(texts)), dtype=np.int64)
        for first, n, words, grams in features(_bytes(texts)):
            span = slice(first, first + n)
            out[0, span] += words
            for found, docs in grams:
                out[1, span] += np.bincount(docs, minlength=n)
                # Sums stay below 2**53, so they are exact.
                out[2, span] += np.bincount(docs, gain[found], minlength=n).astype(np.int64)
        return pa.StructArray.from_arrays([pa.array(x) for x in out], kind.fieldNames())

    return weigh


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Gumbel noise in thousandths, from the key alone; a null key counts as empty."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("bigint")
    return F.floor(F.lit(-1000) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    buckets: int = BUCKETS,
    width: int = WIDTH,
    seed: int = SEED,
    keep: tuple[str, ...] = ("doc_id",),
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """The columns ``keep`` with ``n_features``, ``weight``, ``score`` and ``rank``, all long.

    Words are runs of digits, letters and whatever is beyond ASCII; only A-Z lose their case.
    Of the documents with at least ``least_words`` words, ``percent`` in a hundred, rounded
    down, are drawn: those with the highest scores, ties to the smaller key, null last. The
    others have a null ``rank``.

    Texts without words, null ones too, weigh 0. A null key has the noise of an empty one.
    Repeated rows are rows of their own, and equal ones are ranked in the order in which they
    were stored. Columns to keep that are named like added ones are replaced. Without a
    target text, or without documents, nothing fails. The driver holds two counts a bucket.
    """
    gain = gains(
        bucket_counts(docs, text, buckets, width),
        bucket_counts(target, text, buckets, width),
        buckets,
    )
    kept = [F.col(c) for c in keep if c not in ADDED]
    weighed = docs.select(
        F.struct(*(kept or [F.lit(None).cast("int").alias("nothing")])).alias("kept"),
        F.col(doc_id).alias("key"),
        _weighed(gain, width)(F.col(text).cast("string")).alias("of"),
    )
    scored = cut_lineage(
        weighed.select(
            "kept",
            "key",
            "of.*",
            (F.col("of.weight") + noise(F.col("key"), seed)).alias("score"),
            F.monotonically_increasing_id().alias("row"),
        )
    )
    fit = F.col("n_words") >= least_words
    drawn = scored.where(fit).count() * percent // 100
    order = [
        fit.desc(),
        F.desc("score"),
        F.asc_nulls_last("key"),
        F.asc("row"),
    ]
    rank = F.col("number") + 1
    return numbered(scored, order).select(
        *[F.col("kept")[c].alias(c) for c in keep if c not in ADDED],
        "n_features",
        "weight",
        "score",
        F.when(rank <= drawn, rank).alias("rank"),
    )
