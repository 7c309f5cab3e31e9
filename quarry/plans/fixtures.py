"""Mappings from the driver tables to the inputs of the operators.

Each function reads the parquet tables of one scale-factor directory and
returns a DataFrame; Catalyst prunes the unused columns and pushes filters
into the scans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.scalars import DATE_TEXT_FORMAT

# Fixed values of the fixture mappings.
MARKET_1 = "BUILDING"
MARKET_2 = "AUTOMOBILE"
HOLDOUT_EVERY = 5        # KNN / classifier split: ids divisible by 5 are the query side
BROKEN_EVERY = 7         # dated-text fixture: every 7th event gets a malformed date
N_CLASSES = 10
K_NEIGHBOURS = 5
N_FOLDS = 10


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def overlap_observations_from(li: DataFrame, o: DataFrame, c: DataFrame) -> DataFrame:
    """Observations from given lineitem / orders / customer frames (e.g. the
    bucketed tables of ``quarry.sources.tables``, whose order-key join needs
    no exchange)."""
    oc = o.join(c, o["o_custkey"] == c["c_custkey"])
    # Without column statistics Catalyst sizes the filtered orders-customers
    # side as larger than the two-column lineitem projection and would
    # broadcast the fact table; the hint keeps the fact side streamed
    # (sort-merge on the order key) at every scale.
    return li.hint("merge").join(oc, li["l_orderkey"] == oc["o_orderkey"]).select(
        F.col("o_orderpriority").alias("category"), F.col("l_partkey").alias("item_id"),
        F.col("c_mktsegment").alias("market"))


def overlap_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One observation per lineitem: category = order priority, item = part,
    market = customer segment.

    Join order: orders with customers first (orders-sized), then lineitem on
    the order key, so the lineitem-sized side is shuffled once; the market
    filter of the overlap query is pushed into the customer scan and a
    runtime bloom filter can prune the lineitem side.
    """
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return overlap_observations_from(li, o, c)


def growth_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One observation per order: market = priority, item = customer,
    date = order date, views = total price, tie-break = order key."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("market"), F.col("o_custkey").alias("item_id"),
        F.col("o_orderdate").alias("date_key"), F.col("o_totalprice").alias("views"),
        F.col("o_orderkey").alias("obs_id"))


def dated_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the timestamp rendered as ``yy.dd.MM`` text; some dates have
    dashes instead of dots (every 7th event), one more dot at the end (11th),
    no last piece (13th), an empty last piece (17th) or an empty middle one (19th)."""
    ev = table(spark, sf_dir, "events").select("event_id", "ts")
    txt = F.date_format("ts", DATE_TEXT_FORMAT)
    broken = (F.col("event_id") % BROKEN_EVERY) == 0
    eid = F.col("event_id")
    text = (F.when(broken, F.regexp_replace(txt, r"\.", "-")).when(eid % 11 == 0, F.concat(txt, F.lit(".")))
            .when(eid % 13 == 0, F.substring(txt, 1, 5)).when(eid % 17 == 0, F.substring(txt, 1, 6))
            .when(eid % 19 == 0, F.concat(F.substring(txt, 1, 3), F.substring(txt, 6, 3))).otherwise(txt))
    return ev.select("event_id", text.alias("obs_date"))


def view_text_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A views-as-text column from ``events.props``: the integer ``k`` as text,
    with every 7th made a decimal (``'69.0'``) and every 11th given a leading
    space - both invalid for a strict integer parse."""
    ev = table(spark, sf_dir, "events").select("event_id", "props")
    k = F.regexp_extract("props", r'"k":\s*(-?[0-9]+)', 1)
    eid = F.col("event_id")
    text = (F.when(eid % BROKEN_EVERY == 0, F.concat(k, F.lit(".0")))
            .when(eid % 11 == 0, F.concat(F.lit(" "), k))
            .otherwise(k))
    return ev.select("event_id", text.alias("views_text"))


def quoted_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events rendered as CSV lines ``event_id,event_type,"props"`` with the
    JSON quoted and inner quotes doubled (commas and quotes inside). Every 5th
    line has a stray quote at the end of the event type, every 9th one behind
    the last field."""
    ev = table(spark, sf_dir, "events").select("event_id", "event_type", "props")
    line = F.concat(F.col("event_id").cast("string"), F.lit(","), F.col("event_type"),
                    F.when(F.col("event_id") % 5 == 0, F.lit('"')).otherwise(F.lit("")), F.lit(',"'),
                    F.regexp_replace("props", '"', '""'), F.lit('"'),
                    F.when(F.col("event_id") % 9 == 0, F.lit('"')).otherwise(F.lit("")))
    return ev.select("event_id", line.alias("line"))


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``vec_id, label, vec array<double>``."""
    e = table(spark, sf_dir, "embeddings")
    return e.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("vec"))


def holdout(df: DataFrame, id_col: str = "vec_id") -> tuple[DataFrame, DataFrame]:
    """Split every row into the query side (ids divisible by 5) or the train
    side (the rest): a partition of the whole table, not a sample."""
    is_query = (F.col(id_col) % HOLDOUT_EVERY) == 0
    return df.where(is_query), df.where(~is_query)


def knn_sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    e = embeddings(spark, sf_dir)
    q, t = holdout(e)
    return (q.select(F.col("vec_id").alias("qid"), F.col("label").alias("qlabel"), F.col("vec").alias("qvec")),
            t.select(F.col("vec_id").alias("tid"), F.col("label").alias("tlabel"), F.col("vec").alias("tvec")))


def separable_embeddings(spark: SparkSession, sf_dir: str, apart: float = 1.0) -> DataFrame:
    """``vec_id, label, features`` with feature i = embedding[i] + 1, and
    ``apart`` more where i is the label: every feature is positive, and classes
    far apart leave any sound fit one answer."""
    e = table(spark, sf_dir, "embeddings")
    feats = F.transform("embedding", lambda x, i: x.cast("double") + F.lit(1.0)
                        + F.when(i == F.col("label"), F.lit(apart)).otherwise(F.lit(0.0)))
    return e.select("vec_id", "label", feats.alias("feat_array"))
