"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadkit.llm.shared import stage


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node of its component, for every node of an edge (a, b).

    Alternates between linking each node's larger neighbours, and then its smaller
    ones, to the smallest of them, until every component is a star. Each round is a few
    aggregations and joins on the edges; a node with very many neighbours is
    only aggregated and joined with one row. The driver learns whether to go on.
    """
    now = stage(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges")
    while not _stars(now):
        both = now.select("u", "v").unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        now = _link(both, both.where("v > u"))
        now = stage(_link(now, now), "edges")
    labels = now.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return labels.unionByName(labels.select(F.col("label").alias("node"), "label").distinct())


def _stars(edges: DataFrame) -> bool:
    """Whether every node has one link, and it leads to a node that has none."""
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("out"), F.lit(0).alias("into")).unionByName(
        edges.select(F.col("v").alias("x"), F.lit(0).alias("out"), F.lit(1).alias("into")))
    each = ends.groupBy("x").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
    return each.where("out > 1 OR (out > 0 AND into > 0)").isEmpty()


def _link(around: DataFrame, moved: DataFrame) -> DataFrame:
    """Every moved neighbour v of u, and u itself, is linked to the least of u and its neighbours `around`."""
    least = around.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    out = moved.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return out.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
