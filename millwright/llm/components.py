"""Connected components of a large graph by alternating stars."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwright.llm.common import stored


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """Links (a, b) of two equal-typed columns in, (node, component) out.

    The component is its smallest node. Nodes without a link to another do
    not appear; null ends, loops and repeated links are ignored. Each round
    hangs every neighbour larger than a node under the smallest neighbour,
    then does the same for the smaller ones, and stores the links; the depth
    shrinks geometrically, and no task holds more than a few columns of its
    share. A node with very many links is pre-aggregated before the shuffle,
    and its join is split by the adaptive skew handling.
    """
    edges = stored(
        links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "links",
    )
    state = _state(edges)
    while state[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        nearest = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(nearest, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # every node keeps its smallest neighbour; the other neighbours hang under that one
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(lowest, "a").filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = stored(moved.unionByName(lowest.select("a", F.col("m").alias("b"))).distinct(), "links")
        before, state = state, _state(edges)
        if state == before:
            break
    tops = edges.select(F.col("b").alias("a"), "b")
    return edges.unionByName(tops).distinct().select(F.col("a").alias("node"), F.col("b").alias("component"))
