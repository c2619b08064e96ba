"""Connected components of an edge table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prismtab.session import cut_lineage


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """One round: hang every (larger or smaller) neighbour on the least member of a neighbourhood."""
    if large:
        around = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(edges.select("b", "a"))
    else:
        around = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = around.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    hung = around.join(least, "u")
    if large:
        hung = hung.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        hung = hung.select(F.col("v").alias("a"), F.col("m").alias("b")).unionAll(least.select("u", "m"))
    return hung.where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): root is the least node reachable; nodes without an edge do not appear.

    ``edges`` has two long columns a and b without nulls.  Each round is written to the shared
    checkpoint folder; rounds end when a round changes nothing.  An empty
    edge table gives an empty result.
    """
    def mark(e: DataFrame):
        return e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    edges = cut_lineage(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct())
    seen = mark(edges)
    while seen[0]:
        edges = cut_lineage(_stars(_stars(edges, True), False))
        now = mark(edges)
        if now == seen:
            break
        seen = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
