"""Bucketed tables: store two large tables hash-bucketed (and sorted) on
their join key once, so every later join on that key is planned without an
exchange on either side."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarry.session import scratch_path


def write_bucketed(df: DataFrame, name: str, key: str, n_buckets: int, path: str | None = None) -> DataFrame:
    """Save ``df`` as table ``name`` bucketed and sorted by ``key`` into
    ``n_buckets`` buckets (files under ``path``, by default a fresh folder in
    the shared checkpoint location) and return the table."""
    spark = df.sparkSession
    location = path or scratch_path(spark, f"bucketed-{name}")
    (df.write.mode("overwrite").bucketBy(n_buckets, key).sortBy(key)
     .option("path", location).saveAsTable(name))
    return spark.table(name)


def overlap_inputs_bucketed(spark: SparkSession, sf_dir: str, n_buckets: int,
                            prefix: str = "quarry") -> tuple[DataFrame, DataFrame]:
    """The lineitem and orders columns the overlap query needs, stored
    bucketed by order key with the same bucket count (co-located join)."""
    from quarry.plans.fixtures import table
    li = write_bucketed(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey"),
                        f"{prefix}_lineitem_by_order", "l_orderkey", n_buckets)
    o = write_bucketed(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority"),
                       f"{prefix}_orders_by_order", "o_orderkey", n_buckets)
    return li, o
