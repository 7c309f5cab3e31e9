"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.session import scratch_path


def _written(df: DataFrame) -> DataFrame:
    path = scratch_path(df.sparkSession, "components")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _state(edges: DataFrame) -> tuple:
    """Count and order-free digest of the edges: one row."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def component_minimum(edges: DataFrame) -> DataFrame:
    """node, label (least node of its component) for every node of the long
    columns a and b. Each round writes a table of at most the edges' size; the
    number of rounds grows with the logarithm of the longest path. A node with
    many edges is split by the join's skew handling and never gathered.
    """
    star = _written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = _state(star)
    while state[0]:
        both = star.unionByName(star.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(least, "a").where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        star = _written(moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct())
        before, state = state, _state(star)
        if state == before:
            break
    return star.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(star.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
