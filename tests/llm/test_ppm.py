"""PPM: probabilities sum to one, agree with a plain trie, and the base with plain counts."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from staywise.llm import ppm


def slow_model(texts, order):
    trie = defaultdict(Counter)
    for text in texts:
        whole = [ppm.BEGIN] * order + list(text) + [ppm.END]
        for i in range(order, len(whole)):
            for k in range(order + 1):
                trie[tuple(whole[i - k : i])][whole[i]] += 1
    return trie


def slow_log(trie, context, symbol):
    """Method D with exclusion, from the longest context down."""
    total, out = 0.0, set()
    for k in range(len(context), -1, -1):
        seen = trie.get(tuple(context[len(context) - k :]), {})
        left = {s: n for s, n in seen.items() if s not in out}
        if left:
            base = 2 * sum(left.values())
            if symbol in left:
                return total + math.log10((2 * left[symbol] - 1) / base)
            total += math.log10(len(left) / base)
            out |= set(left)
    return total - math.log10(ppm.SYMBOLS - len(out))


def slow_score(trie, text, order):
    whole = [ppm.BEGIN] * order + list(text) + [ppm.END]
    return sum(slow_log(trie, whole[i - order : i], whole[i]) for i in range(order, len(whole)))


def held(doc_id, folds=10):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % folds == 0


@pytest.mark.parametrize("order", [2, 5])
@pytest.mark.parametrize("name", ["small", "odd_documents", "no_documents"])
def test_same_as_plain_trie(name, order, request, documents):
    docs = documents.where("length(text) < 600") if name == "small" else request.getfixturevalue(name)
    docs = docs.where("length(text) < 5000 or text is null").select("doc_id", "text")
    rows = [(r.doc_id, (r.text or "").encode().lower()) for r in docs.collect()]
    training = [t for k, t in rows if not held(k)]
    trie = slow_model(training, order)
    words = Counter(w for t in training for w in [*t.split(), None])
    total, kinds = sum(words.values()), len(words)
    floor = total + 0.1 * (kinds + 1)
    expected = Counter()
    for key, text in rows:
        tokens = [*text.split(), None]
        base = sum(math.log10((words[w] + 0.1) / floor) for w in tokens)
        known = sum(words[w] > 0 for w in tokens)
        score = slow_score(trie, text, order)
        expected[key, held(key), len(tokens), known, total, f"{base:.6f}", f"{score:.6f}"] += 1
    found = Counter(
        (r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, f"{r.base_score:.6f}", f"{r.score:.6f}")
        for r in ppm.score(docs.repartition(3), order=order).collect()
    )
    assert found == expected


def test_probabilities_of_all_symbols_sum_to_one():
    texts = [b"abracadabra", b"banana band", b"cab"]
    grams = np.concatenate([c for t in texts for c in ppm.gram_slices(t, 3)])
    counts = np.ones(len(grams), dtype=np.int64)
    levels = [ppm._Level.of(grams & ((1 << 8 * (k + 1)) - 1), counts) for k in range(4)]
    for context in (b"abr", b"zzz", b"zza", b"\xff\xff\xff", b"ban"):
        prefix = int.from_bytes(context, "big") << 8
        codes = np.arange(ppm.SYMBOLS, dtype=np.int64) | prefix
        assert abs((10 ** ppm.log_probabilities(codes, levels)).sum() - 1) < 1e-9


def test_slices_of_a_long_text(monkeypatch):
    text = bytes(range(97, 123)) * 40
    whole = np.concatenate(list(ppm.gram_slices(text, 4)))
    monkeypatch.setattr(ppm, "_SLICE", 100)
    assert np.array_equal(np.concatenate(list(ppm.gram_slices(text, 4))), whole)


def test_lookup():
    draw = np.random.default_rng(2)
    keys = np.append(draw.integers(-(1 << 63), 1 << 62, 5000), np.arange(3000) << 40)
    keys = np.append(keys, keys[:100])
    known = ppm.Lookup(keys, keys * 0.5)
    sought = draw.choice(keys, 20_000)
    assert np.array_equal(known.of(sought), sought * 0.5)
    with pytest.raises(KeyError):
        known.of(np.array([12345]))
    assert len(ppm.Lookup(keys[:0], keys[:0] * 0.5).of(keys[:0])) == 0


@pytest.mark.parametrize("blocks", [2, 5])
def test_scores_do_not_depend_on_the_blocks(documents, blocks):
    docs = documents.where("length(text) < 3000").coalesce(1)
    expected = {r.doc_id: (r.train_tokens, r.n_known, r.score) for r in ppm.score(docs).collect()}
    found = ppm.score(docs.repartition(blocks)).collect()
    assert len(found) == len(expected)
    for r in found:
        tokens, known, score = expected[r.doc_id]
        assert (r.train_tokens, r.n_known) == (tokens, known)
        assert r.score == pytest.approx(score, abs=1e-6)


@pytest.mark.parametrize("kind", ["smallint", "double", "string", "date"])
def test_keys_of_any_type(spark, kind):
    key = "date_add(date'2020-01-01', cast(id as int))" if kind == "date" else "id"
    docs = spark.range(9).selectExpr(f"cast({key} as {kind}) AS doc_id", "repeat('ab c ', cast(id as int)) AS text")
    found = ppm.score(docs)
    assert found.schema["doc_id"].dataType.simpleString() == kind
    assert sorted(r.n_tokens for r in found.collect()) == [1 + 2 * i for i in range(9)]
