"""Connected components of a link table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridewise.llm.common import cut_lineage, join_side


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step over undirected edges ``a > b``: neighbours of a node on
    the far side (large: above it, small: not above it) move to the smallest one."""
    if large:
        both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        out = both.where(F.col("b") > F.col("a")).join(join_side(low, "star"), "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        low = join_side(edges.groupBy("a").agg(F.min("b").alias("m")), "star")
        moved = edges.join(low, "a")
        out = moved.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(low.select("a", F.col("m").alias("b")))
    return out.where(F.col("a") != F.col("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """``node, comp`` for every node of ``links`` (two long columns ``a``,
    ``b``); ``comp`` is the smallest node of the component.

    Ends when a round changes nothing, which happens after about log n rounds.
    Every round is one written table. A node's neighbours are reduced to their
    smallest map-side, and the smallest ones are written before they are joined
    back, so both inputs are plain exchanges and a hub's rows can be split.
    """
    edges = cut_lineage(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                             .where(F.col("a") != F.col("b")).distinct(), "links")
    mark = None
    while True:
        edges = cut_lineage(_star(_star(edges, True), False), "links")
        now = edges.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0))).first()
        if mark == (now[0], now[1]):
            break
        mark = (now[0], now[1])
    roots = edges.select(F.col("b").alias("a")).distinct().select("a", F.col("a").alias("b"))
    return edges.unionByName(roots).select(F.col("a").alias("node"), F.col("b").alias("comp"))
