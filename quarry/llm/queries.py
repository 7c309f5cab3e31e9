"""Registered queries of the operators, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import (collocations, decontaminate, importance, jaccard_join, license_scan, packing, prefix_trie, quality_rules, spot_signatures,
                        substring_dedup, suffix_dedup, toxicity, url_filter)
from quarry.llm import sql

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: The site rules that the URL contract names.
SITE_RULES = [url_filter.site_rule("net/", "block"), url_filter.site_rule("example.net/en/", "allow"),
              url_filter.site_rule("example.com/de/", "block"), url_filter.site_rule("org/fr/", "allow")]


@register("op1_url_filter", sql.URL_FILTER)
def op1_url_filter(spark, sf_dir):
    rules = SITE_RULES + [url_filter.word_rule(w, "block") for w in url_filter.BLOCKED_HOST_WORDS]
    judged = url_filter.judge_urls(table(spark, sf_dir, "pages"), rules)
    site = F.when(F.col("matched_rule").isin([r.name for r in SITE_RULES]), F.col("matched_rule"))
    return judged.select("page_id", "host", "path", site.alias("rule"), "verdict")


@register("op8_quality_rules")
def op8_quality_rules(spark, sf_dir):
    judged = quality_rules.judge_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", "kept", "bad_rule")


@register("op9_packing")
def op9_packing(spark, sf_dir):
    pieces = packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id",
                         "offset", "bucket")


@register("op2_suffix_dedup")
def op2_suffix_dedup(spark, sf_dir):
    out = suffix_dedup.remove_repeated_bytes(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"))


@register("op3_substring_dedup")
def op3_substring_dedup(spark, sf_dir):
    out = substring_dedup.remove_repeated_windows(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


@register("op5_decontamination", sql.DECONTAMINATION)
def op5_decontamination(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = decontaminate.find_contamination(docs, table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda n, r: n + (r["end"] - r["start"]))
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (F.size("hits") > 0).alias("contaminated"))


@register("op6_quality_classifier")
def op6_quality_classifier(spark, sf_dir):
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register("op10_license_scan")
def op10_license_scan(spark, sf_dir):
    found = license_scan.scan_licenses(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "license", "template", "n_shingles", "n_found", "first_word")


@register("op4_toxicity")
def op4_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    model = toxicity.fit(docs, table(spark, sf_dir, "labels").where(~held_out))
    scored = toxicity.score_toxicity(docs, model)
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@register("op7_jaccard_join")
def op7_jaccard_join(spark, sf_dir):
    return jaccard_join.similarity_classes(table(spark, sf_dir, "documents"), shingle=4, percent=85)


@register("op11_document_fingerprints")
def op11_document_fingerprints(spark, sf_dir):
    found = spot_signatures.edited_fingerprints(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
                        spot_signatures.fingerprint("signatures").alias("fingerprint"),
                        spot_signatures.fingerprint("edited_signatures").alias("edited_fingerprint"), "near_edited", "near_next")


@register("op12_conversation_trie", sql.TRIE)
def op12_conversation_trie(spark, sf_dir):
    return prefix_trie.conversation_trie(table(spark, sf_dir, "conversations"))


@register("op13_phrase_collocations", sql.COLLOCATIONS)
def op13_phrase_collocations(spark, sf_dir):
    return collocations.top_collocations(collocations.collocations(table(spark, sf_dir, "documents")))
