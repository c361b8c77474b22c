"""Connected components of a graph given as a table of edges, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowtables.session import cut


def _large(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node points to the smallest node around it."""
    both = edges.select("u", "v").unionAll(edges.select(F.col("v"), F.col("u")))
    both = both.toDF("u", "v")
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours point to the smallest of them."""
    low = edges.groupBy("u").agg(F.min("v").alias("m"))
    around = edges.join(low, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return around.unionAll(low.toDF("u", "v"))


def _state(edges: DataFrame) -> tuple:
    """Number of edges and an order-free sum over them; equal states end the contraction."""
    part = F.pmod(F.xxhash64("u", "v"), F.lit(1 << 40))
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(part)).first())


def components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """Smallest reachable node of every node that has an edge: columns ``node`` and ``root``.

    Nodes may be of any ordered type; edges with a null end and loops are ignored. Each round is a
    few aggregations and joins by node whose result is cut to the shared folder; rounds grow with
    the logarithm of the component's size. The roots themselves are listed too.
    """
    pairs = edges.select(F.col(left).alias("u"), F.col(right).alias("v")).where("u <> v")
    now = cut(
        pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    )
    before = None
    while (state := _state(now)) != before:
        before = state
        now = cut(_small(_large(now).distinct()).distinct())
    roots = now.select(F.col("v").alias("node")).distinct().withColumn("root", F.col("node"))
    return cut(now.toDF("node", "root").unionAll(roots))
