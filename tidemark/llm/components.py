"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.store import stored


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for the nodes of ``edges (a, b)``; a component is named by its least node.

    Loops, repeated edges, either direction and nulls are allowed; an edge with
    a null joins nothing and its nodes do not appear.  An empty table gives an
    empty result.  Each round is written out, so a lost executor costs at most
    one round; a node with very many neighbours is only ever a join key beside
    a stored table, which adaptive execution splits.
    """
    kept = edges.where(F.col("a").isNotNull() & F.col("b").isNotNull())
    nodes = stored(kept.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "nodes")
    stars = stored(_downward(kept.where("a <> b")).distinct(), "edges")
    while _unfinished(stars):
        stars = _small_star(_large_star(stars))
    found = stars.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.join(found, "node", "left").select("node", F.coalesce("component", "node").alias("component"))


def _downward(edges: DataFrame) -> DataFrame:
    return edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))


def _unfinished(stars: DataFrame) -> bool:
    """Whether a node hangs on two others, or on one that hangs on another itself."""
    roles = stars.select(F.explode(F.array(F.struct(F.col("a").alias("node"), F.lit(1).alias("child"), F.lit(0).alias("centre")),
                                           F.struct(F.col("b").alias("node"), F.lit(0).alias("child"), F.lit(1).alias("centre")))).alias("r"))
    per_node = roles.groupBy("r.node").agg(F.sum("r.child").alias("child"), F.max("r.centre").alias("centre"))
    return not per_node.where("child + centre > 1").isEmpty()


def _large_star(stars: DataFrame) -> DataFrame:
    """Hang the larger neighbours of every node on the least of its neighbourhood."""
    both = stars.select(F.explode(F.array(F.struct(F.col("a").alias("u"), F.col("b").alias("v")),
                                          F.struct(F.col("b").alias("u"), F.col("a").alias("v")))).alias("e")).select("e.u", "e.v")
    least = stored(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
    return stored(both.join(least, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct(), "large")


def _small_star(stars: DataFrame) -> DataFrame:
    """Hang every node and its smaller neighbours on the least of these."""
    down = _downward(stars)
    least = stored(down.groupBy("a").agg(F.min("b").alias("m")), "least")
    hung = down.join(least, "a").select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
                                                          F.struct(F.col("a"), F.col("m").alias("b")))).alias("e"))
    return stored(hung.select("e.a", "e.b").where("a <> b").distinct(), "small")
