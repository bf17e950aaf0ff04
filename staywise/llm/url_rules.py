"""Allow and block rules over URLs: a sort-merge range join with a sorted sweep.

A rule's canonical key is its host with the labels reversed, a dot, and its path:
``example.org/es/`` becomes ``org.example./es/``. A URL has such a key for its host and for
each parent domain. A rule fits where its key begins a URL's key, so each rule is the
interval from its key to the last key that it begins, and intervals are nested or apart.
Rules and URLs are sorted together and swept; where an interval starts its rule becomes the
top of the stack, where it ends the enclosing rule does again, and a URL takes the top.

The sweep runs in shards. Each shard has its share of the URLs, dealt by hash, whatever
host they are on, and all rules; a shard has at least as many URLs as rules, so the rules'
copies never outnumber the URLs.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from staywise.llm.common import partitions

#: Sorts after whatever follows a prefix in a key.
LAST = "\U0010ffff"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_URL = "(?s)^.*?://([^/?#]*)([^?#]*)"
ADDED = ("host", "path", "rule", "verdict")


def host_of(url: Column) -> Column:
    host = F.translate(F.regexp_extract(url, _URL, 1), UPPER, LOWER)
    return F.coalesce(host, F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def _key(labels: Column, path: Column) -> Column:
    return F.concat(F.array_join(F.reverse(labels), "."), F.lit("."), path)


def _rules(rules: DataFrame) -> DataFrame:
    """One row per rule: ``key``, ``top`` and the enclosing rule's ``outer``, if any."""
    host = F.translate(F.col("host"), UPPER, LOWER)
    path = F.coalesce("path", F.lit(""))
    keyed = rules.where("host is not null and verdict is not null").select(
        _key(F.split(host, r"\.", -1), path).alias("key"),
        F.concat(host, path).alias("rule"),
        "verdict",
    )
    top = F.struct(F.length("rule").alias("length"), "rule", "verdict")
    # The same rule twice: the larger verdict by name, so block before allow.
    single = keyed.groupBy("key").agg(F.max(top).alias("top"))
    shorter = single.select(
        "key", F.explode(F.sequence(F.lit(1), F.length("key"))).alias("n")
    ).select("key", F.expr("left(key, n - 1)").alias("begin"))
    outer = (
        shorter.join(single.select(F.col("key").alias("begin"), "top"), "begin")
        .groupBy("key")
        .agg(F.max_by("top", F.length("begin")).alias("outer"))
    )
    return single.join(outer, "key", "left")


def _events(rules: DataFrame) -> DataFrame:
    """Where the top of the stack changes: at each interval's end and start."""
    end = F.struct(
        F.concat("key", F.lit(LAST)).alias("key"),
        F.lit(0).alias("kind"),
        F.struct(F.col("outer").alias("now")).alias("stack"),
    )
    start = F.struct(
        F.col("key"), F.lit(1).alias("kind"), F.struct(F.col("top").alias("now")).alias("stack")
    )
    return rules.select(F.inline(F.array(end, start)))


def _best(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """The longest rule per (host, path); URLs without a fitting rule have no row."""
    spark = urls.sparkSession
    ruled = _rules(rules)
    n_rules, depth = ruled.agg(
        F.count("*"), F.max(F.size(F.split(F.regexp_extract("key", r"^[^/]*", 0), r"\.")))
    ).first()
    if not n_rules:
        return None
    labels = F.split("host", r"\.", -1)
    # Parent domains deeper than any rule's host need no row.
    ancestors = F.transform(
        F.sequence(F.greatest(F.lit(1), F.size(labels) - depth + 1), F.size(labels)),
        lambda i: _key(F.slice(labels, i, F.size(labels)), F.col("path")),
    )
    distinct = urls.select("host", "path").where("host != ''").distinct()
    few = max(1, urls.count() // (2 * n_rules))
    shards = min(few, 4 * partitions(spark))
    shard = F.pmod(F.xxhash64("host", "path"), F.lit(shards))
    rows = distinct.select(shard.alias("shard"), F.explode(ancestors).alias("key"), "host", "path")
    every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(shards - 1).cast("bigint")))
    swept = (
        rows.withColumn("kind", F.lit(2))
        .unionByName(
            _events(ruled).select(every.alias("shard"), "*"), allowMissingColumns=True
        )
        .withColumn(
            "found",
            F.last("stack", ignorenulls=True).over(
                W.partitionBy("shard").orderBy("key", "kind").rowsBetween(
                    W.unboundedPreceding, W.currentRow
                )
            ),
        )
        .where("kind = 2 and found.now is not null")
    )
    return swept.groupBy("host", "path").agg(F.max("found.now").alias("best"))


def judge(
    pages: DataFrame, rules: DataFrame, default: str = "allow", url: str = "url"
) -> DataFrame:
    """Each page with ``host``, ``path``, the longest fitting ``rule`` and its ``verdict``.

    ``rules`` has ``host``, ``path`` and ``verdict``; a rule fits its host and all
    subdomains where the URL's path starts with the rule's. Without a fitting rule ``rule``
    is null and ``verdict`` the default. Of two equally long rules the later by name wins.

    Null or relative URLs have an empty host and path and fit no rule. Every row stays,
    repeated ones too; columns of ``pages`` named like the added ones are replaced. A rule
    without host or verdict is left out, a null path is empty.
    """
    split = pages.select(
        *[c for c in pages.columns if c not in ADDED],
        host_of(F.col(url)).alias("host"),
        path_of(F.col(url)).alias("path"),
    )
    best = _best(split, rules)
    if best is None:
        return split.select(
            "*", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict")
        )
    others = [c for c in split.columns if c not in ADDED]
    return split.join(best.withColumnRenamed("best", "_best"), ["host", "path"], "left").select(
        *others,
        "host",
        "path",
        F.col("_best.rule").alias("rule"),
        F.coalesce("_best.verdict", F.lit(default)).alias("verdict"),
    )
