"""Connected components by joins, for graphs of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from upkeep.llm.store import Kept


def components(edges: DataFrame, kept: Kept) -> DataFrame:
    """Smallest node reachable from each node of the edges (a, b): node, component.

    Every round hangs each node's larger neighbours on its smallest one, then each
    node and its smaller neighbours on the smallest of those. The rounds needed grow
    with the logarithm of the longest path; the edges never grow in number, and a
    node with very many neighbours is only ever aggregated, not collected. Edges
    with a null end are left out. Nodes without edges are not returned.
    """
    now = kept.keep(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    while not _stars(now):
        both = now.select("a", "b").unionAll(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        large = kept.keep(large, "large")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionAll(least.select("a", F.col("m").alias("b")))
        after = kept.keep(small.distinct(), "edges")
        kept.drop(now, large)
        now = after
    result = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return result.unionAll(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def _stars(edges: DataFrame) -> bool:
    """Whether every node hangs on one other, which hangs on none: the smallest of its component."""
    if not edges.groupBy("a").count().where("count > 1").isEmpty():
        return False
    return edges.join(edges.select(F.col("a").alias("b")).hint("merge"), "b", "left_semi").isEmpty()


def blocked(rows: DataFrame, node: str, size: int) -> DataFrame:
    """Rows with a count n of their group, once for each pair of blocks they belong to.

    Adds block, low, side. A group of up to ``size`` rows is one block; in a larger one
    each pair of blocks is a task's work of its own.
    """
    rows = rows.withColumn("blocks", F.ceil(F.col("n") / size).cast("int"))
    rows = rows.withColumn("block", F.pmod(F.xxhash64(node), F.col("blocks")).cast("int"))
    rows = rows.withColumn("beside", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return rows.withColumn("low", F.least("block", "beside")).withColumn("side", F.greatest("block", "beside")).drop("blocks", "beside")
