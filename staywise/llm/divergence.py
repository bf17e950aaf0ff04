"""How far the sources of a language are apart, by their shares of its frequent terms.

The index is term-major: one row per kept term of a language, with the count of every source
that has it. Its terms are dealt into blocks. In a block, each group (a source of the
language) scatters its terms through the index into a dense accumulator with a place for
every peer, so no pair of postings ever becomes a row; a block's result is one row per pair
of groups.

Shares are smoothed, so a term that a group lacks still has a share, the group's baseline.
With p and q the shares of groups g and h, and b their baselines, the distance

    sum over all terms of |p - q|

is, over a block of ``n`` terms,

    sum over the terms of both of |p - q| - |p - b_h| - |b_g - q| + |b_g - b_h|
      + sum over g's terms of |p - b_h| + sum over h's terms of |q - b_g|
      + (n - terms of g - terms of h) * |b_g - b_h|

The first line is what is scattered; the second follows from each group's sorted shares and
their running sums; the last is the correction for terms that neither has.
"""

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from staywise.llm.common import cut_lineage

#: A term is kept in a language with so many documents that have it.
LEAST_DOCS = 30
SMOOTH = 5
SCALE = 1_000_000_000
TERMS = 50

#: Postings in a block, about; groups whose accumulators a task fills.
BLOCK = 16_384
TILE = 1_024
#: Different terms that a task holds before it passes their counts on.
HELD = 1 << 18
#: Bytes of a text that are looked at together, but for the last word.
CHUNK = 1 << 22

_TERM = re.compile(rb"[a-z\x80-\xff]+")
_GAP = re.compile(rb"[^a-z\x80-\xff]")


def _parts(text: bytes) -> Iterator[bytes]:
    """The text in lower case, cut between words."""
    text, begin = text.lower(), 0
    while len(text) - begin > CHUNK and (gap := _GAP.search(text, begin + CHUNK)):
        yield text[begin : gap.start()]
        begin = gap.end()
    yield text[begin:]


class _Counts:
    """Occurrences and documents of each term, by language and source."""

    def __init__(self):
        self.groups: dict[tuple, tuple[Counter, Counter]] = {}

    def add(self, group: tuple, text: bytes) -> None:
        if group not in self.groups:
            self.groups[group] = Counter(), Counter()
        count, docs = self.groups[group]
        met: set[bytes] = set()
        for part in _parts(text):
            terms = _TERM.findall(part)
            count.update(terms)
            met.update(terms)
        docs.update(met)

    def __len__(self) -> int:
        return sum(len(count) for count, _ in self.groups.values())

    def flush(self) -> Iterator[pa.RecordBatch]:
        for (lang, source), (count, docs) in self.groups.items():
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * len(count), pa.string()),
                    pa.array([source] * len(count), pa.string()),
                    pa.array(list(count), pa.binary()),
                    pa.array(count.values(), pa.int64()),
                    pa.array([docs[t] for t in count], pa.int64()),
                ],
                ["lang", "source", "term", "n", "docs"],
            )
        self.groups = {}


def _counted(batches):
    counts, seen = _Counts(), 0
    for batch in batches:
        lang, source, text = batch.columns
        for k in range(batch.num_rows):
            counts.add((lang[k].as_py(), source[k].as_py()), text[k].as_buffer().to_pybytes())
            seen += len(text[k].as_buffer())
            # As many terms as this would be few words.
            if seen > 4 * HELD:
                if len(counts) > HELD:
                    yield from counts.flush()
                seen = 0
    yield from counts.flush()


def index(docs: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """``lang, term, n, postings`` of kept terms; a posting is (source, n). Stored.

    ``docs`` has ``lang``, ``source`` and ``text``, none null. Tasks count before anything
    is shuffled, and the rows of a term meet once, on language and term.
    """
    rows = docs.select("lang", "source", "text").mapInArrow(
        _counted, "lang string, source string, term binary, n bigint, docs bigint"
    )
    per_source = (
        rows.repartition("lang", "term")
        .groupBy("lang", "term", "source")
        .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    )
    posting = F.struct("source", "n")
    return cut_lineage(
        per_source.groupBy("lang", "term")
        .agg(
            F.sum("n").alias("n"),
            F.sum("docs").alias("docs"),
            F.collect_list(posting).alias("postings"),
        )
        .where(F.col("docs") >= least_docs)
        .drop("docs")
    )


def groups(docs: DataFrame, indexed: DataFrame) -> DataFrame:
    """Every (lang, source) with its ``place`` in the language and the sums that shares need.

    ``total`` and ``lang_total`` count kept terms, ``vocabulary`` is the number of those,
    ``blocks`` and ``tiles`` say how the language's work is dealt. Stored.
    """
    langs = indexed.groupBy("lang").agg(
        F.count("*").alias("vocabulary"),
        F.sum("n").alias("lang_total"),
        F.sum(F.size("postings")).alias("links"),
    )
    totals = (
        indexed.select("lang", F.inline("postings"))
        .groupBy("lang", "source")
        .agg(F.sum("n").alias("total"))
    )
    listed = docs.select("lang", "source").distinct()
    by_name = W.partitionBy("lang").orderBy("source")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("bigint").alias(c)
    tiles = F.ceil(F.count("*").over(W.partitionBy("lang")) / TILE).cast("int")
    return cut_lineage(
        listed.join(totals, ["lang", "source"], "left")
        .join(langs, "lang", "left")
        .select(
            "lang",
            "source",
            (F.row_number().over(by_name) - 1).alias("place"),
            zero("total"),
            zero("lang_total"),
            zero("vocabulary"),
            F.greatest(F.ceil(F.coalesce("links", F.lit(0)) / BLOCK), F.lit(1)).cast("int").alias("blocks"),
            tiles.alias("tiles"),
        )
    )


def share(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    """``1 + floor(SCALE * (count + SMOOTH) / total)``, three digits at a time, so that it is
    exact in 64 bits for totals below 9 * 10**15. ``total`` has the smoothing in it."""
    rest, found = count + SMOOTH, np.zeros_like(count)
    for _ in range(3):
        rest = rest * 1000
        found = found * 1000 + rest // total
        rest = rest % total
    return found + 1


def _apart(shares: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """For each mark the sum of all shares' distances to it."""
    ordered = np.sort(shares)
    upto = np.concatenate([[0], np.cumsum(ordered)])
    below = np.searchsorted(ordered, marks, side="right")
    return (
        marks * below - upto[below]
        + (upto[-1] - upto[below]) - marks * (len(ordered) - below)
    )


def _best(values: np.ndarray, terms: list[bytes], limit: int) -> list[tuple[int, bytes]]:
    """The ``limit`` largest values, ties to the smaller term."""
    if len(values) > limit:
        least = np.partition(values, len(values) - limit)[len(values) - limit]
        near = np.flatnonzero(values >= least)
    else:
        near = np.arange(len(values))
    found = sorted((-int(values[i]), terms[i]) for i in near)
    return [(-v, t) for v, t in found[:limit]]


def _block(limit: int):
    def block(key, terms: pa.Table, peers: pa.Table) -> pa.Table:
        lang, _, tile = (k.as_py() for k in key)
        order = np.argsort(peers.column("place").to_numpy())
        place = {s: i for i, s in enumerate(peers.column("source").take(order).to_pylist())}
        total = peers.column("total").to_numpy()[order]
        vocabulary = peers.column("vocabulary")[0].as_py()
        lang_total = peers.column("lang_total")[0].as_py()
        n_groups, n_terms = len(place), terms.num_rows
        smoothed = np.maximum(total + SMOOTH * vocabulary, 1)
        base = share(np.zeros(n_groups, dtype=np.int64), smoothed)

        # Term-major: the postings of term t are those from start[t] to start[t + 1].
        lists = terms.column("postings").combine_chunks()
        flat = lists.flatten() if n_terms else None
        start = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())]) if n_terms else np.zeros(1, int)
        sources = flat.field("source").to_pylist() if n_terms else []
        of_group = np.fromiter((place[s] for s in sources), np.int64, len(sources))
        counts = flat.field("n").to_numpy() if n_terms else np.zeros(0, np.int64)
        p = share(counts, smoothed[of_group])
        of_term = np.repeat(np.arange(n_terms), np.diff(start))
        names = terms.column("term").to_pylist()
        known = terms.column("n").to_numpy() if n_terms else np.zeros(0, np.int64)
        in_lang = share(known, np.full(n_terms, max(lang_total + SMOOTH * vocabulary, 1)))

        # Group-major: a group's postings in the order of terms.
        by_group = np.argsort(of_group, kind="stable")
        mine = np.concatenate([[0], np.cumsum(np.bincount(of_group, minlength=n_groups))])
        low, high, value = [], [], []
        top: list[tuple[int, int, bytes]] = []
        everyone = np.arange(n_groups)
        for g in range(tile * TILE, min((tile + 1) * TILE, n_groups)):
            held = by_group[mine[g] : mine[g + 1]]
            own, t = p[held], of_term[held]
            # Through the index: every posting of every term of the group.
            size = start[t + 1] - start[t]
            at = np.arange(size.sum()) + np.repeat(start[t] - (np.cumsum(size) - size), size)
            # Each pair once: to later peers only.
            later = of_group[at] > g
            at, spread = at[later], np.repeat(own, size)[later]
            peer, q = of_group[at], p[at]
            met = np.abs(spread - q) - np.abs(spread - base[peer])
            met += np.abs(base[peer] - base[g]) - np.abs(base[g] - q)
            # Sums stay far below 2**53, so they are exact.
            row = np.bincount(peer, met, minlength=n_groups).astype(np.int64)
            neither = n_terms - (mine[g + 1] - mine[g]) - np.diff(mine)
            row += np.where(everyone > g, neither * np.abs(base - base[g]), 0)
            # g's own terms against each peer's baseline; the peer adds its own against g's.
            row += _apart(own, base)
            if not vocabulary:
                row[:] = 0
            others = everyone != g
            low.append(np.minimum(everyone, g)[others])
            high.append(np.maximum(everyone, g)[others])
            value.append(row[others])
            above = own - in_lang[t]
            more = np.flatnonzero(above > 0)
            best = _best(above[more], [names[i] for i in t[more]], limit)
            top += [(g, v, term) for v, term in best]

        a = np.concatenate([*low, [g for g, _, _ in top]]).astype(np.int32)
        b = pa.array(np.concatenate([np.zeros(0), *high]).astype(np.int32))
        v = np.concatenate([*value, [x for _, x, _ in top]]).astype(np.int64)
        return pa.table({
            "lang": pa.array([lang] * len(a), pa.string()),
            "a": a,
            "b": pa.concat_arrays([b, pa.nulls(len(top), pa.int32())]),
            "item": pa.concat_arrays([
                pa.nulls(len(b), pa.binary()), pa.array([x for _, _, x in top], pa.binary())
            ]),
            "value": v,
        })

    return block


def _parts_of_distances(indexed: DataFrame, grouped: DataFrame, limit: int) -> DataFrame:
    """(lang, a, b, value) per block and pair, (lang, a, item, value) per block and top term."""
    dealt = grouped.groupBy("lang").agg(F.max("blocks").alias("blocks"), F.max("tiles").alias("tiles"))
    each_tile = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("tile")
    terms = indexed.join(dealt, "lang").select(
        "lang", "term", "n", "postings",
        F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int").alias("block"),
        each_tile,
    )
    peers = grouped.select(
        "lang", "source", "place", "total", "lang_total", "vocabulary", "tiles",
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
    ).select("*", each_tile)
    keys = ["lang", "block", "tile"]
    return cut_lineage(
        terms.groupBy(*keys)
        .cogroup(peers.groupBy(*keys))
        .applyInArrow(_block(limit), "lang string, a int, b int, item binary, value bigint")
    )


def audit(
    docs: DataFrame,
    least_docs: int = LEAST_DOCS,
    limit: int = TERMS,
    lang: str = "lang",
    source: str = "source",
    text: str = "text",
) -> DataFrame:
    """``lang, source, part, item, value, rank``: how each source differs, and by what.

    Part ``pair`` has a row for every other source of the language, the farthest first;
    part ``term`` the ``limit`` terms of which the source has most above the language's
    share. Values are in units of 1 / ``SCALE``, exact; ties go to the item with the smaller
    UTF-8 bytes.

    Null languages, sources and texts count as empty ones. A source without terms has its
    smoothed shares; a language without kept terms has distances of 0 and no terms. A source
    alone in its language has no pairs. Repeated rows count as often as they occur; columns
    beside the three are not looked at.
    """
    of = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    plain = docs.select(of(lang).alias("lang"), of(source).alias("source"), of(text).alias("text"))
    indexed = index(plain, least_docs)
    grouped = groups(plain, indexed)
    found = _parts_of_distances(indexed, grouped, limit)
    summed = (
        found.where(F.col("b").isNotNull())
        .groupBy("lang", "a", "b")
        .agg(F.sum("value").alias("value"))
    )
    both = summed.select("lang", "value", F.inline(F.array(F.struct("a", "b"), F.struct(
        F.col("b").alias("a"), F.col("a").alias("b")
    ))))
    name = grouped.select("lang", F.col("place").alias("a"), "source")
    peer = grouped.select("lang", F.col("place").alias("b"), F.col("source").alias("item"))
    pairs = both.join(name, ["lang", "a"]).join(peer, ["lang", "b"]).select(
        "lang", "source", F.lit("pair").alias("part"), "item", "value"
    )
    terms = (
        found.where(F.col("item").isNotNull())
        .join(name, ["lang", "a"])
        .select("lang", "source", F.lit("term").alias("part"), F.col("item").cast("string").alias("item"), "value")
    )
    order = W.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    ranked = [df.select("*", F.row_number().over(order).alias("rank")) for df in (pairs, terms)]
    return ranked[0].unionByName(ranked[1].where(F.col("rank") <= limit))
