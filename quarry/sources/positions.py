"""Row ids that are places in the files: the number of rows before a row, in
the order of file names and places in a file.

A row knows its place in its split; the rows of each split are counted and
summed over the splits before it. The ids depend neither on how large the
splits are nor on how they are packed into tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def with_file_position(df: DataFrame, id_col: str = "row_id") -> DataFrame:
    """``df``, read from files without a shuffle, with the place of each row
    among all rows (from 0). Rows that the reader drops are not counted.

    The splits (a row each, however large the files) are ordered in one window
    and joined back, by broadcast where Spark finds them small; no row of
    ``df`` is sorted.
    """
    if id_col in df.columns:
        raise ValueError(f"the column {id_col} exists already")
    placed = df.withColumns({"_file": F.input_file_name(), "_start": F.input_file_block_start(), "_row": F.monotonically_increasing_id()})
    splits = placed.groupBy("_file", "_start").agg(F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first"))
    before = Window.orderBy("_file", "_start").rowsBetween(Window.unboundedPreceding, -1)
    shift = splits.select("_file", "_start", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"))
    return placed.join(shift, ["_file", "_start"]).withColumn(id_col, F.col("_row") + F.col("_shift")).drop("_file", "_start", "_row", "_shift")
