"""Observation analytics: per-category market overlap and early growth.

Input is a DataFrame of observations with (at least) an item id, a category,
a market, a date key and a view count; column names are arguments.

Scale notes
-----------
* ``category_overlap`` is two hash aggregates. The first groups by
  (category, item) - a high-cardinality key, so a hot category is spread over
  all reducers - and runs a map-side partial aggregate, so a hot item is
  collapsed before the shuffle. The second level (per category) moves at most
  one partial row per category and map partition.
* ``first_n_by_date`` is ``row_number() <= n``; Spark plans it as
  ``WindowGroupLimit(Partial)`` before the exchange, so at most ``n`` rows per
  key and map partition cross the shuffle even when one key holds a third of
  the data. The per-key aggregate that follows reuses the window's
  partitioning (no second shuffle).
* The threshold filter runs before the global sort, so the range-partitioned
  sort only sees surviving rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.scalars import growth_line, growth_pct, overlap_line, trunc_long


def filter_markets(obs: DataFrame, markets: Sequence[str], market: str = "market") -> DataFrame:
    """Keep rows whose market is one of ``markets`` (exact, case-sensitive)."""
    return obs.where(F.col(market).isin(list(markets)))


def market_flags(obs: DataFrame, market1: str, market2: str, category: str = "category",
                 item: str = "item_id", market: str = "market") -> DataFrame:
    """Per (category, item): whether the item was seen in market 1 / market 2."""
    m = F.col(market)
    return (filter_markets(obs, [market1, market2], market)
            .groupBy(category, item)
            .agg(F.max((m == F.lit(market1)).cast("int")).alias("in_m1"),
                 F.max((m == F.lit(market2)).cast("int")).alias("in_m2")))


def category_overlap(obs: DataFrame, market1: str, market2: str, category: str = "category",
                     item: str = "item_id", market: str = "market") -> DataFrame:
    """Per category: distinct items seen in ``market1`` (``count_m1``), how many
    of them were also seen in ``market2`` (``overlap``), and
    ``pct = overlap / count_m1 * 100``. Categories without any market-1 item
    are dropped.

    Output: ``category, count_m1 bigint, overlap bigint, pct double``.
    """
    if market1 == market2:
        raise ValueError("market1 and market2 must differ")
    flags = market_flags(obs, market1, market2, category, item, market)
    per_cat = flags.groupBy(category).agg(
        F.sum("in_m1").cast("bigint").alias("count_m1"),
        F.sum(F.col("in_m1") * F.col("in_m2")).cast("bigint").alias("overlap"))
    return (per_cat.where(F.col("count_m1") > 0)
            .select(F.col(category).alias("category"), "count_m1", "overlap",
                    (F.col("overlap").cast("double") / F.col("count_m1").cast("double")
                     * F.lit(100.0)).alias("pct")))


def category_overlap_text(overlap: DataFrame, market2: str) -> DataFrame:
    """Render ``category_overlap`` rows as ``total <n>; <pct>% in <market2>``."""
    return overlap.select("category", overlap_line("count_m1", "pct", market2).alias("line"))


def first_n_by_date(obs: DataFrame, keys: Sequence[str], order: Sequence[Column | str],
                    n: int = 2, rank_col: str = "rn") -> DataFrame:
    """The ``n`` earliest rows per key (ties broken by the later order columns)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return obs.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= n)


def growth_first_two(obs: DataFrame, keys: Sequence[str] = ("market", "item_id"),
                     date: str = "date_key", views: str = "views", tiebreak: str | None = None,
                     zero_base: str = "null") -> DataFrame:
    """Per key: percent growth of views between the two earliest dated rows.

    Rows with a NULL date are invalid and only count when nothing valid is
    left; a key with fewer than two valid rows gets 0. ``zero_base`` handles a
    zero first value (see ``growth_pct``).

    Rows of one date are ordered by ``tiebreak``, NULL last. ``n_used`` counts
    the valid rows among the two earliest.

    Output: ``*keys, n_used bigint, early, late, pct double``.
    """
    order = [F.col(date).asc_nulls_last()]
    if tiebreak:
        order.append(F.col(tiebreak).asc_nulls_last())
    valid = F.col(date).isNotNull()
    ranked = first_n_by_date(obs, keys, order, 2, "_rn")
    per_key = ranked.groupBy(*keys).agg(
        F.count(F.when(valid, 1)).alias("n_used"),
        F.max(F.when(valid & (F.col("_rn") == 1), F.col(views))).alias("early"),
        F.max(F.when(valid & (F.col("_rn") == 2), F.col(views))).alias("late"))
    pct = F.when(F.col("n_used") < 2, F.lit(0.0)).otherwise(growth_pct("early", "late", zero_base))
    return per_key.withColumn("pct", pct)


def sort_market_growth(growth: DataFrame, market: str = "market", item: str = "item_id") -> DataFrame:
    """Global order: market descending, truncated percent descending, item."""
    return growth.orderBy(F.col(market).desc(), F.col("pct_trunc").desc(), F.col(item).asc())


def growth_report(growth: DataFrame, threshold: int = 1000, market: str = "market",
                  item: str = "item_id") -> DataFrame:
    """Keep keys whose truncated growth is at least ``threshold`` percent,
    add the report line, and sort (market desc, growth desc).

    Output: ``market, item_id, pct, pct_trunc bigint, line``.
    """
    kept = (growth.withColumn("pct_trunc", trunc_long("pct"))
            .where(F.col("pct_trunc") >= F.lit(threshold))
            .select(F.col(market).alias("market"), F.col(item).alias("item_id"), "pct", "pct_trunc",
                    growth_line(market, item, "pct").alias("line")))
    return sort_market_growth(kept)
