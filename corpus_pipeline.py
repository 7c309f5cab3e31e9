"""The corpus pipeline: documents -> kept, deduplicated, decontaminated, packed.

Each stage takes (spark, docs, sf_dir), works on every row its predecessor kept
and returns the columns of documents, the last one packed pieces. ``run``
applies them in order; between stages a table is written to the shared folder
and read again, so a lost executor never repeats more than one stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import decontaminate, jaccard_join, packing, quality_rules, substring_dedup
from quarry.session import scratch_path

#: Near copies of the Jaccard stage: words of a shingle, least percent of common shingles.
SHINGLE, PERCENT = 5, 80
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    rules = quality_rules.learn(quality_rules.labelled_rows(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    stats = quality_rules.text_statistics(docs.select(F.struct(*COLUMNS).alias("_doc"), "doc_id", "text"), keep=("_doc",))
    kept = stats.where(~quality_rules.base_failed() & quality_rules.rule_number(rules).isNull())
    return kept.select("_doc.*")


def jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One text of each group of near copies (from 80 % of common five-word
    shingles on): the one of least id, of rows that share this id the one of
    least hash of id and text; null ids come last.

    Every text takes part for itself, also where its id is null or other rows
    share it: such rows go only as near copies of a text that stays. Rows equal
    in id and text are one (the first by lang, source and n_chars); null texts
    and texts without words have no copies.
    """
    own = F.xxhash64("doc_id", "text")  # 64 bits stand for id and text, as for a shingle
    keyed = docs.select(*COLUMNS, own.alias("_key"))
    classes = jaccard_join.similarity_classes(keyed, "_key", shingle=SHINGLE, percent=PERCENT)
    classes = classes.select(F.col("doc_id").alias("_key"), "component_id").distinct()
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("_key"))
    first = keyed.select("doc_id", "_key").distinct().join(classes.hint("merge"), "_key").groupBy("component_id").agg(F.min(order).alias("_first"))
    # equal rows are combined before the shuffle
    row = F.struct("lang", "source", "n_chars", "doc_id", "text")
    distinct = keyed.groupBy("_key").agg(F.min(row).alias("_row"))
    return distinct.join(first.select("_first._key").hint("merge"), "_key").select(*(f"_row.{c}" for c in COLUMNS))


def substring(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the word windows of earlier documents; a text of nothing else goes."""
    out = substring_dedup.remove_repeated_windows(docs, join_words=False, carry=F.struct("lang", "source"))
    out = out.where((F.col("n_removed") < F.col("n_words")) | (F.col("n_words") == 0))
    return out.select("doc_id", F.col("kept").alias("text"), "carried.lang", "carried.source", F.length("kept").cast("long").alias("n_chars"))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no window with the benchmark."""
    return decontaminate.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of power-of-two lengths."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality_rules", quality), ("jaccard_join", jaccard), ("substring_dedup", substring), ("decontamination", decontaminated),
          ("packing", pack)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the last stage over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
