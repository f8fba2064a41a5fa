"""Connected components of a link table, by alternating stars.

Each round first links all larger neighbours of a node to its smallest one,
then all smaller ones. Rounds end when nothing changes, after about log(n) of
them. Every round is written to the shared folder, so a lost executor costs one
round; no links reach the driver: its joins merge, as a broadcast would be built
there, and a small graph would have two of them a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenkeel.sources.shared import materialize


def _state(links: DataFrame) -> tuple:
    row = links.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
    return tuple(row)


def components(links: DataFrame) -> DataFrame:
    """(node, component) for all nodes of ``links`` (a, b); the component is
    the smallest node that links reach. Nodes without links are not listed;
    repeated links and links of a node to itself change nothing; rows with a
    null are ignored."""
    edges = materialize(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "links")
    state = _state(edges)
    while state[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least.hint("merge"), "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(down.hint("merge"), "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = materialize(
            small.unionByName(down.withColumnRenamed("m", "b")).where("a <> b").distinct(), "links")
        now = _state(edges)
        if now == state:
            break
        state = now
    stars = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("node"), "component").distinct())
