"""Connected components of a large edge list by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import settle


def _signature(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0)).alias("h"),
    ).first()
    return row["n"], int(row["h"])


def _star(pairs: DataFrame, keep: str) -> DataFrame:
    """Hang the neighbours of ``u`` on the smallest of them (``u`` included).

    The minima are stored first: both sides of the join are then plain shuffles, of which Spark
    can split the partition of a node with very many neighbours.
    """
    low = settle(
        pairs.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("low")), "star-minima"
    )
    joined = pairs.join(low, "u")
    if keep == "large":
        return joined.filter("v > u").select(F.col("v").alias("a"), F.col("low").alias("b"))
    hung = joined.select(F.col("v").alias("a"), F.col("low").alias("b")).filter("a <> b")
    return hung.union(low.select(F.col("u").alias("a"), F.col("low").alias("b")))


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges`` (columns a, b: BIGINT, any order).

    The root is the smallest node of the component. Each round is a large star (larger
    neighbours go to the smallest neighbour) and a small star (smaller ones likewise); rounds end
    when the edge set stays the same, after about log(nodes) of them. No component is ever
    gathered in one task: a round only takes minima, which combine before the shuffle, and
    joins. Only a count and a checksum per round reach the driver. Loops and repeated edges are
    dropped; nulls take no part.
    """
    ordered = edges.filter("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    current = settle(ordered.distinct(), "edges")
    before = _signature(current)
    while True:
        both = current.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
            current.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
        large = settle(_star(both, "large").filter("a <> b").distinct(), "large-star")
        down = large.select(F.col("a").alias("u"), F.col("b").alias("v"))
        current = settle(_star(down, "small").filter("a <> b").distinct(), "small-star")
        after = _signature(current)
        if after == before:
            break
        before = after
    roots = current.select(F.col("a").alias("node"), F.col("b").alias("root"))
    own = current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return roots.union(own)
