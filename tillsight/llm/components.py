"""Connected components of a link table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillsight.llm.common import materialize


def connected_components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``(node, component)`` for every node of ``links(a, b)``; the component is its smallest node.

    Each round points every node's larger neighbours, then its smaller ones, at
    the smallest node it knows (both are aggregates and joins, AQE splits a hot
    node), until no link changes; the number of rounds grows with the logarithm
    of the longest chain.  Each round's links are written to the shared folder.
    """
    links = materialize(links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                        .distinct(), "links")
    for _ in range(max_rounds):
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = (both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")))
        small_least = large.where("a != b").groupBy("a").agg(F.min("b").alias("m"))
        small = (large.where("a != b").join(small_least, "a")
                 .select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"),
                         F.col("m").alias("b")).where("a != b").distinct())
        new = materialize(small, "links")
        # a star forest: nobody points at a node that points further
        if new.join(new.select(F.col("a").alias("b")).distinct(), "b", "left_semi").isEmpty() and not _split(new):
            links = new
            break
        links = new
    else:
        raise RuntimeError("the components did not converge")
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        links.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()


def _split(links: DataFrame) -> bool:
    """Whether a node still points at two others."""
    return not links.groupBy("a").count().where("count > 1").isEmpty()
