"""The operators applied to whole tables, and the SQL for those that SQL can express."""

from pyspark.sql import functions as F

from staywise.llm import (
    divergence,
    mixing,
    nbsvm,
    packing,
    passages,
    pivots,
    ppm,
    resampling,
    sharding,
    simhash,
    surrogates,
    topk,
    url_rules,
)
from staywise.llm.common import held_out, table
from staywise.llm.oracle import ORACLE as ORACLE

#: (host, path, verdict); a rule covers the host's subdomains.
URL_RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)

#: Kept secret in production; whoever holds it can tell which surrogate is whose.
SURROGATE_KEY = "public example key"


def op1_topk_search(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return topk.top(vectors, F.col("vec_id") % 50 == 0)


def op2_ppm_scores(spark, sf_dir):
    return ppm.score(table(spark, sf_dir, "documents"))


def op3_mix_sources(spark, sf_dir):
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op4_pack_sequences(spark, sf_dir):
    cut = packing.pieces(table(spark, sf_dir, "documents"))
    parts = cut.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return packing.pack(parts)


def op5_repeated_passages(spark, sf_dir):
    left = passages.drop_repeats(table(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op6_url_filter(spark, sf_dir):
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_rules.judge(pages, rules).select("page_id", "host", "path", "rule", "verdict")


def op7_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = nbsvm.fit(docs, table(spark, sf_dir, "labels"))
    return nbsvm.classify(docs, model).select(
        "doc_id", held_out(F.col("doc_id"), nbsvm.FOLDS).alias("held_out"), "score", "predicted"
    )


def op8_vector_classes(spark, sf_dir):
    return pivots.classes(table(spark, sf_dir, "embeddings"))


def op9_simhash_classes(spark, sf_dir):
    classed = simhash.classes(table(spark, sf_dir, "documents"))
    hexed = F.lpad(F.lower(F.hex("print")), 16, "0")
    return classed.select("doc_id", hexed.alias("fingerprint"), "component_id")


def op10_pii_surrogates(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return surrogates.replace(docs, SURROGATE_KEY)


def op11_shard_slots(spark, sf_dir):
    return sharding.place(table(spark, sf_dir, "documents"))


def op12_importance_draw(spark, sf_dir):
    docs, target = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return resampling.resample(docs, target)


def op13_source_divergence(spark, sf_dir):
    return divergence.audit(table(spark, sf_dir, "documents"))


QUERIES = {
    query.__name__: query
    for query in (
        op1_topk_search,
        op2_ppm_scores,
        op3_mix_sources,
        op4_pack_sequences,
        op5_repeated_passages,
        op6_url_filter,
        op7_quality,
        op8_vector_classes,
        op9_simhash_classes,
        op10_pii_surrogates,
        op11_shard_slots,
        op12_importance_draw,
        op13_source_divergence,
    )
}
