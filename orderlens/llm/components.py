"""Connected components of a graph of links, by alternating stars.

Each round is two groupings and two joins of the links, so nothing is collected and a node
with very many neighbours is pre-aggregated before the shuffle; its join is split at run time.
Each round is written to the shared folder and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.session import cut_lineage


def _large_star(links: DataFrame) -> DataFrame:
    """Larger neighbours of every node move to the least node around it."""
    both = links.union(links.select("b", "a")).toDF("a", "b")
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    return both.where("b > a").join(least.hint("merge"), "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """Smaller neighbours of every node, and the node, move to the least of them."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(least.hint("merge"), "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", "m")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of the links (a, b); component is its least node.

    Links to oneself and repeated links are allowed. No links, no rows.
    """
    now = cut_lineage(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    state = None
    while True:
        mark = now.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if tuple(mark) == state or not mark[0]:
            break
        state = tuple(mark)
        now = cut_lineage(_small_star(_large_star(now)))
    roots = now.select(F.col("b").alias("node")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        roots.select("node", F.col("node").alias("component"))
    )
