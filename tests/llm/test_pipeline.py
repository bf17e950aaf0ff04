"""The pipeline's stages, each judged on its own input, on the smallest tables."""

import zlib
from collections import Counter

import numpy as np
import pytest
from test_packing import laid_out
from test_simhash import slow_classes

import corpus_pipeline
from staywise.llm import nbsvm, packing


@pytest.fixture(scope="module")
def kept(spark, sf_dir, tmp_path_factory, documents):
    """Each stage's result, read back."""
    found, docs = {"documents": documents}, documents
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = found[name] = spark.read.parquet(path)
    return found


def test_columns_of_documents(kept):
    for name in ("quality", "near_dedup", "pii", "mix"):
        assert kept[name].schema == kept["documents"].schema


def test_quality_keeps_what_the_model_accepts(kept, labels):
    held = [(r.doc_id, (r.text or "").encode()) for r in kept["documents"].collect()]
    label = {r.doc_id: r.quality for r in labels.collect()}
    rows = sorted(
        (zlib.crc32(str(i).encode()), i, nbsvm.features(t), label[i])
        for i, t in held
        if i in label and zlib.crc32(str(i).encode()) % nbsvm.FOLDS
    )
    model = nbsvm.train([r[2] for r in rows], np.array([r[3] for r in rows]))
    expected = {i for i, t in held if model.score(nbsvm.features(t)) >= nbsvm.THRESHOLD}
    assert {r.doc_id for r in kept["quality"].collect()} == expected


def test_one_document_of_each_class_stays(kept):
    rows = [(r.doc_id, r.text) for r in kept["quality"].collect()]
    names = sorted({name for _, _, name in slow_classes(rows)})
    assert sorted(str(r.doc_id) for r in kept["near_dedup"].collect()) == names


def test_pii_changes_texts_only(kept):
    before = {r.doc_id: r for r in kept["near_dedup"].collect()}
    after = {r.doc_id: r for r in kept["pii"].collect()}
    assert before.keys() == after.keys()
    changed = [i for i in before if before[i].text != after[i].text]
    assert 0 < len(changed) < len(before) // 2
    for i in changed:
        assert after[i].n_chars == len(after[i].text)
        assert len(before[i].text.split()) == len(after[i].text.split())


def test_mix_repeats_whole_documents(kept):
    source = {r.doc_id: r.text for r in kept["pii"].collect()}
    copies = Counter(r.doc_id for r in kept["mix"].collect())
    assert copies.keys() <= source.keys() and max(copies.values()) <= 3
    sizes = {i: len((t or "").split()) for i, t in source.items()}
    budget = sum(sizes.values())
    assert budget - max(sizes.values()) <= sum(n * sizes[i] for i, n in copies.items()) <= budget


def test_pack_holds_every_document(kept):
    rows = kept["pack"].collect()
    laid_out(rows)
    copies = Counter(r.doc_id for r in kept["mix"].collect())
    assert Counter(r.doc_id for r in rows if r.start == 0) == copies
    encode = packing.encoder()
    tokens = sum(len(encode(r.text or "")) + 1 for r in kept["mix"].collect())
    assert sum(r.length for r in rows) == tokens
