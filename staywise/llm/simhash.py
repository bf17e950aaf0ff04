"""SimHash near-duplicates through an inverted index of positional bytes.

A fingerprint has 8 bytes. Two that differ in at most 4 bits agree in at least 4 of their
positional bytes. The index lists fingerprints under the bytes that they have at three
positions together; the 20 triples in ``TRIPLES`` are such that any four positions contain
one of them, so a pair that shares four bytes meets in some list. For each pair that meets,
the shared positional bytes are tallied, pairs that reach the guaranteed minimum are kept,
and the differing bits are counted. A pair counts only in the first list that both are in.
"""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import LongType

from staywise.llm import pairing
from staywise.llm.common import cut_lineage, partitions, unused
from staywise.llm.components import components

SEED = 42
SHINGLE = 4
BITS = 4
POSITIONS = 8
#: Turan's system for 8 points: three in a group, or two in one and one in the next.
_GROUPS = ((0, 1, 2), (3, 4, 5), (6, 7))


def _triples() -> tuple[tuple[int, int, int], ...]:
    found = [g for g in _GROUPS if len(g) == 3]
    for k, group in enumerate(_GROUPS):
        for i, x in enumerate(group):
            for y in group[i + 1 :]:
                found += [tuple(sorted((x, y, z))) for z in _GROUPS[(k + 1) % 3]]
    return tuple(sorted(found))


TRIPLES = _triples()
_CHUNK = 1 << 16


def _bits(hashes: np.ndarray) -> np.ndarray:
    return np.unpackbits(
        hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"
    ).sum(axis=0, dtype=np.int64)


def fingerprint(text: bytes, width: int = SHINGLE, seed: int = SEED) -> int:
    """64 bits, each set if set in over half the shingles' hashes."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    hash64 = xxhash.xxh64_intdigest
    if len(words) <= width:
        return hash64(joined, seed)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1
    ends = np.cumsum(lengths) - 1
    starts = (ends - lengths + 1)[: 1 - width].tolist()
    ends = ends[width - 1 :].tolist()
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(starts), _CHUNK):
        pieces = zip(starts[at : at + _CHUNK], ends[at : at + _CHUNK], strict=True)
        hashes = np.fromiter(
            (hash64(joined[i:j], seed) for i, j in pieces), dtype=np.uint64
        )
        counts += _bits(hashes)
    majority = (counts * 2 > len(starts)).astype(np.uint8)
    return int.from_bytes(np.packbits(majority, bitorder="little").tobytes(), "little")


@arrow_udf(LongType())
def _fingerprints(texts: pa.Array) -> pa.Array:
    prints = [
        0 if not t.is_valid else fingerprint(bytes(t.as_buffer())) for t in texts
    ]
    return pa.array(np.array(prints, dtype=np.uint64).view(np.int64))


def fingerprint_of(text: Column) -> Column:
    """The fingerprint as a signed long; zero for null, empty and blank texts."""
    return _fingerprints(text)


def _postings(prints: DataFrame) -> DataFrame:
    """(list, print): each fingerprint under its bytes at each triple of positions."""

    def at(position):
        return F.shiftrightunsigned("print", 8 * position).bitwiseAND(F.lit(255))

    keys = [
        F.lit(k << 24)
        + F.shiftleft(at(x), 16)
        + F.shiftleft(at(y), 8)
        + at(z)
        for k, (x, y, z) in enumerate(TRIPLES)
    ]
    return prints.select(F.explode(F.array(*keys)).alias("list"), "print")


def _first_triple() -> np.ndarray:
    """The first triple inside each set of positions, as a mask; -1 if none."""
    first = np.full(1 << POSITIONS, -1, dtype=np.int64)
    for k, triple in reversed(list(enumerate(TRIPLES))):
        mask = sum(1 << p for p in triple)
        first[(np.arange(1 << POSITIONS) & mask) == mask] = k
    return first


def _found(bits: int):
    first = _first_triple()
    weights = (1 << np.arange(POSITIONS)).astype(np.int64)
    minimum = POSITIONS - bits

    def found(table: pa.Table) -> pa.RecordBatch:
        prints = table.column("print").to_numpy().view(np.uint64)
        lists = table.column("_group").to_numpy() >> 24

        def links():
            for left, right in pairing.shifts(table):
                differ = prints[left] ^ prints[right]
                shared = differ.view(np.uint8).reshape(-1, POSITIONS) == 0
                tally = shared.sum(axis=1)
                near = (tally >= minimum) & (np.bitwise_count(differ) <= bits)
                near &= first[shared @ weights] == lists[left]
                yield left[near], right[near]

        left, right = pairing.forest(table.num_rows, links())
        signed = prints.view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(signed[left]), pa.array(signed[right])], ["a", "b"])

    return found


def links(prints: DataFrame, bits: int = BITS, tile: int = pairing.TILE) -> DataFrame:
    """Links between distinct fingerprints that connect all that are near; (a, b).

    ``prints`` has distinct longs in ``print``. Not every near pair is a row, but every
    near pair is connected.
    """
    if not 0 <= bits <= POSITIONS - 4:
        raise ValueError("the index serves distances of at most 4 bits")
    placed = pairing.tiled(_postings(prints), "list", F.xxhash64("print"), tile)
    n = 2 * partitions(prints.sparkSession)
    return pairing.mapped(placed, _found(bits), "a bigint, b bigint", n)


def _members(docs: DataFrame, bits: int, doc_id: str, text: str, tile: int) -> DataFrame:
    """The rows of ``classes`` with ``component``, the class's own fingerprint."""
    printed = cut_lineage(
        docs.select(
            F.col(doc_id).alias("doc_id"),
            F.xxhash64(text).alias("row"),
            fingerprint_of(F.col(text)).alias("print"),
        )
    )
    smallest = cut_lineage(printed.groupBy("print").agg(F.min("doc_id").alias("least")))
    found = components(links(smallest.select("print"), bits, tile))
    classed = smallest.join(
        found.withColumnRenamed("node", "print"), "print", "left"
    ).withColumn("component", F.coalesce("component", "print"))
    names = classed.groupBy("component").agg(F.min("least").alias("component_id"))
    named = cut_lineage(
        classed.join(names, "component").select("print", "component", "component_id")
    )
    return printed.join(named, "print")


def classes(
    docs: DataFrame,
    bits: int = BITS,
    doc_id: str = "doc_id",
    text: str = "text",
    tile: int = pairing.TILE,
) -> DataFrame:
    """One row per document: ``doc_id``, ``row``, ``print`` and ``component_id``.

    ``component_id`` is the smallest key that links of at most ``bits`` differing bits
    reach; ``row`` is a hash of the row's text, to tell rows of one key apart. Texts
    without words have fingerprint zero and link like others. Null keys are members but
    never name a class: a class of null keys alone has a null ``component_id``.
    """
    return _members(docs, bits, doc_id, text, tile).select("print", "doc_id", "row", "component_id")


def keep_one(
    docs: DataFrame, bits: int = BITS, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One document of each class: the one with the smallest key, its first by text hash.

    A class of null keys alone keeps one row. Equal rows of the kept document become one.
    All columns stay, whatever their names.
    """
    member = _members(docs, bits, doc_id, text, pairing.TILE)
    rank = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("row"))
    chosen = member.groupBy("component").agg(F.min(rank).alias("first"))
    key, row = unused("key", docs.columns), unused("row", docs.columns)
    kept = chosen.select(
        F.coalesce(F.col("first.doc_id").cast("string"), F.lit("")).alias(key),
        F.col("first.row").alias(row),
    ).distinct()
    rows = docs.select(
        "*",
        F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias(key),
        F.xxhash64(text).alias(row),
    )
    return rows.join(kept, [key, row], "left_semi").dropDuplicates([key, row]).select(*docs.columns)
