"""Connected components of an edge table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import settle


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``root`` for every node of ``edges(a, b)``: the root is the
    smallest node of its component and is listed with itself.

    Large-star and small-star steps in turn (each one aggregate and one join
    per edge) until every edge leads from a node to its root. Each round is
    written to the shared folder; the driver sees two counts per round. Self
    edges are allowed; an empty table gives no rows.
    """
    forest = settle(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                    .filter("a <> b").distinct(), "edges")
    while True:
        parents = forest.select(F.col("b").alias("p")).distinct()
        loose = (forest.groupBy("a").count().filter("count > 1").count()
                 or forest.join(parents, F.col("a") == F.col("p"), "left_semi").count())
        if not loose:
            break
        both = forest.union(forest.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy(F.col("a").alias("u")).agg(F.least(F.min("b"), F.min("a")).alias("m"))
        large = (both.join(low, F.col("a") == F.col("u")).filter("b > a")
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        low = large.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
        small = (large.join(low, F.col("a") == F.col("u")).filter("b <> m")
                 .select(F.greatest("b", "m").alias("a"), F.least("b", "m").alias("b"))
                 .union(low.select("u", "m")))
        forest = settle(small.filter("a <> b").distinct(), "edges")
    roots = forest.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return forest.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
