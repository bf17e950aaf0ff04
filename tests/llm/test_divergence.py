"""Distances of sources against their definition, term by term."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from staywise.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def slow_audit(docs, least, limit=50):
    langs, seen = defaultdict(lambda: defaultdict(Counter)), defaultdict(Counter)
    for lang, source, text in docs:
        terms = TERM.findall((text or "").translate(LOWER))
        langs[lang or ""][source or ""].update(terms)
        seen[lang or ""].update(set(terms))
    rows = []
    for lang, sources in langs.items():
        kept = [t for t, n in seen[lang].items() if n >= least]

        def shares(count, kept=kept):
            total = sum(count[t] for t in kept) + 5 * len(kept)
            return {t: 1 + 10**9 * (count[t] + 5) // total for t in kept}

        p = {s: shares(c) for s, c in sources.items()}
        q = shares(sum(sources.values(), Counter()))
        for s, count in sources.items():
            pair = [(sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in sources if o != s]
            term = [(p[s][t] - q[t], t) for t in kept if count[t] and p[s][t] > q[t]]
            for part, found in (("pair", pair), ("term", term)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                for k, (value, item) in enumerate(found[: None if part == "pair" else limit]):
                    rows.append((lang, s, part, item, value, k + 1))
    return Counter(rows)


@pytest.mark.parametrize("name, least", [("documents", 5), ("documents", 30), ("odd_documents", 1), ("odd_documents", 99)])
@pytest.mark.parametrize("block, tile", [(16_384, 1024), (40, 3)])
def test_audit(name, least, block, tile, request, monkeypatch):
    """Also with so small blocks and tiles that every language has many."""
    monkeypatch.setattr(divergence, "BLOCK", block)
    monkeypatch.setattr(divergence, "TILE", tile)
    monkeypatch.setattr(divergence, "CHUNK", 1000)
    docs = request.getfixturevalue(name)
    found = divergence.audit(docs, least)
    assert found.columns == ["lang", "source", "part", "item", "value", "rank"]
    expected = slow_audit([(r.lang, r.source, r.text) for r in docs.collect()], least)
    assert Counter(map(tuple, found.collect())) == expected


def test_nothing_to_audit(no_documents):
    assert divergence.audit(no_documents).collect() == []


def test_terms_are_passed_on_before_they_are_many(spark, monkeypatch, documents):
    monkeypatch.setattr(divergence, "HELD", 50)
    expected = slow_audit([(r.lang, r.source, r.text) for r in documents.collect()], 10)
    assert Counter(map(tuple, divergence.audit(documents, 10).collect())) == expected


def test_shares_of_large_counts():
    counts = [0, 1, 7, 10**6, 10**12, 8 * 10**15]
    total = 9 * 10**15
    found = divergence.share(np.array(counts), np.full(len(counts), total))
    assert found.tolist() == [1 + 10**9 * (c + 5) // total for c in counts]
    assert divergence.share(np.array([0]), np.array([5])).tolist() == [1 + 10**9]


def test_ties_and_many_sources(spark):
    """Sources with the same words, and names whose order is that of their bytes."""
    rows = [("xx", s, t) for s in ("b", "B", "é", "", "zz", "Z", "a" * 9) for t in ("one two", "two ONE")]
    rows += [("xx", "other", "three one"), ("xx", "empty", None), ("yy", "alone", "one"), (None, None, "1 2")]
    docs = spark.createDataFrame(rows, "lang string, source string, text string")
    for least in (1, 2, 15):
        assert Counter(map(tuple, divergence.audit(docs, least).collect())) == slow_audit(rows, least)
