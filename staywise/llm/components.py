"""Connected components of a graph that no single task could hold.

Alternating large and small stars: each round links every node's neighbours to the smallest
of them, until each component is one star around its smallest node. The rounds number about
the logarithm of the longest path. Smallest neighbours come from an aggregate, which
combines before it shuffles, and are stored before they are joined, so that Spark can split
the join where one node has very many neighbours.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staywise.llm.common import cut_lineage


def _linked(pairs: DataFrame) -> DataFrame:
    """(a, b) with a > b, each once."""
    return (
        pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .where("a > b")
        .distinct()
    )


def _smallest(neighbours: DataFrame) -> DataFrame:
    return cut_lineage(neighbours.groupBy("a").agg(F.min("b").alias("least")))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    reach = both.join(_smallest(both), "a").where("b > a")
    return _linked(reach.select(F.col("b").alias("a"), F.least("a", "least").alias("b")))


def _small_star(edges: DataFrame) -> DataFrame:
    near = edges.join(_smallest(edges), "a")
    return _linked(
        near.select(F.inline(F.array(
            F.struct(F.col("a"), F.col("least").alias("b")),
            F.struct(F.col("b").alias("a"), F.col("least").alias("b")),
        )))
    )


def _state(edges: DataFrame):
    return edges.agg(
        F.count("*"), F.sum((F.xxhash64("a", "b") % 1_000_003).cast("bigint"))
    ).first()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node with an edge; ``edges`` has long ``a`` and ``b``.

    The component is its smallest node. Edges may repeat, point either way, or be loops,
    which are left out with their nodes unless others touch them.
    """
    stars = cut_lineage(_linked(edges))
    state = _state(stars)
    while state[0]:
        stars = cut_lineage(_small_star(cut_lineage(_large_star(stars))))
        before, state = state, _state(stars)
        if state == before:
            break
    roots = stars.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    leaves = stars.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return leaves.unionByName(roots)
