"""Connected components of a graph that is spread over the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import Scratch


def connected_components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """Rows ``node, root`` for every node of the links ``a, b``; root is the least node.

    Alternates large-star and small-star steps, which need a number of rounds that grows
    with the logarithm of the longest chain. Each step joins links with one minimum per
    node, found by a partial aggregate, so no node's neighbours are gathered. Each round is
    written to the shared scratch folder: it cuts the lineage and survives lost executors.
    Links of a node with itself and repeated links change nothing; no links give no rows.
    """
    links, found = scratch.write(
        edges.filter("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        {"n": F.count("*")},
    )
    if not found["n"]:
        return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    state = None
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # Large star: every greater neighbour of a node is linked to its least neighbour.
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(
            F.col("a").alias("u"), F.least("a", "m").alias("m")
        )
        large = (
            links.join(least, links["b"] == least["u"])
            .select(F.col("a"), F.col("m").alias("b"))
            .distinct()
        )
        # Small star: every lesser neighbour, and the node, is linked to the least one.
        low = large.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), "m")
        small = large.join(low, large["a"] == low["u"]).select(
            F.explode(F.array(F.struct(F.col("a").alias("x"), F.col("m").alias("y")),
                              F.struct(F.col("b").alias("x"), F.col("m").alias("y")))).alias("e")
        )
        links, found = scratch.write(
            small.select(F.col("e.x").alias("a"), F.col("e.y").alias("b")).filter("a <> b").distinct(),
            # Equal sums over two rounds mean equal links, up to a chance of 2^-64.
            {"n": F.count("*"), "s": F.bit_xor(F.xxhash64("a", "b"))},
        )
        now = (found["n"], found["s"])
        if now == state:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        state = now
