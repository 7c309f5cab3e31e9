"""Benchmark decontamination by winnowing, with SQL functions only.

Of every window of ``length`` words the least hash among its runs of ``GRAM``
words is kept, with its place: the fingerprint. A fingerprint depends on the
window's words alone, so a window of a benchmark item that occurs in a document
has the same fingerprint, at the same place, in both: joining fingerprints and
comparing the words around them loses no shared span of ``length`` words.
Consecutive windows mostly share a fingerprint, so a document sends only a
fraction of its words to the join. Items shorter than ``length`` are one window
each; for every such size that occurs all runs of that many words are sent.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.columns import gram_hashes, token_words
from quarry.session import scratch_path

GRAM = 6
#: Low bits of a fingerprint that hold its place; a text has fewer words.
PLACE_BITS = 30
#: Distinct benchmark windows up to this number are broadcast, more are joined by shuffle.
BROADCAST_WINDOWS = 100_000
#: Contaminated documents up to this number are broadcast to be left out, more are joined by shuffle.
BROADCAST_HITS = 500_000

def _longs() -> Column:
    return F.array().cast("array<bigint>")


def placed_hashes(words: Column, length: int, gram: int) -> Column:
    """Hash and place of every run of ``gram`` words; none in a text under ``length`` words."""
    hashes = gram_hashes(words, gram)
    return F.when(F.size(words) >= length, F.transform(hashes, lambda h, i: F.shiftleft(h, PLACE_BITS).bitwiseOR(i.cast("bigint")))).otherwise(_longs())


def least_of_windows(placed: Column, runs: int) -> Column:
    """The least of every ``runs`` placed hashes in a row, each once."""
    least = F.transform(F.sequence(F.lit(1), F.size(placed) - (runs - 1)), lambda i: F.array_min(F.slice(placed, i, runs)))
    return F.when(F.size(placed) >= runs, F.array_distinct(least)).otherwise(_longs())


def place(fingerprint: Column) -> Column:
    return fingerprint.bitwiseAND(F.lit((1 << PLACE_BITS) - 1)).cast("int")


def _window_rows(items: DataFrame, length: int, gram: int) -> DataFrame:
    """Distinct windows of the benchmark: size, words of the window, its
    fingerprint without place, the fingerprint's place in it, and its items."""
    whole = items.where(F.size("_words") > 0)
    size = F.least(F.size("_words"), F.lit(length))
    starts = F.sequence(F.lit(1), F.size("_words") - size + 1)
    rows = whole.select("_item", F.explode(F.transform(starts, lambda i: F.slice("_words", i, size))).alias("_window"))
    rows = rows.withColumn("_size", F.size("_window"))
    gram_of = F.when(F.col("_size") >= length, F.lit(gram)).otherwise(F.col("_size"))
    placed = F.transform(F.sequence(F.lit(1), F.col("_size") - gram_of + 1),
                         lambda i: F.shiftleft(F.xxhash64(F.slice("_window", i, gram_of)), PLACE_BITS).bitwiseOR((i - 1).cast("bigint")))
    rows = rows.groupBy("_window", "_size").agg(F.collect_set("_item").alias("_items"))
    best = rows.withColumn("_best", F.array_min(placed))
    return best.select("_size", "_window", "_items", F.shiftright("_best", PLACE_BITS).alias("_print"), place(F.col("_best")).alias("_inside"))


def benchmark_windows(items: DataFrame, item_id: str, text_col: str, length: int, gram: int) -> DataFrame:
    return _window_rows(items.select(F.col(item_id).alias("_item"), token_words(F.col(text_col)).alias("_words")), length, gram)


def find_contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       item_id: str = "item_id", item_text: str = "text", length: int = 10, gram: int = GRAM) -> DataFrame:
    """doc_id, tag (hash of the text), n_words, hits (start and end of the
    maximal runs of hit words) and items (sorted as strings), one row per input
    row; both arrays are empty where nothing is shared.

    Words are runs of ASCII letters (lower-cased), digits and non-ASCII
    characters. A hit word lies inside an occurrence of a window: ``length``
    consecutive words of an item, or a whole shorter item with words. Null and
    empty texts have no words; items without words or with a null id match
    nothing; rows with a null id and repeated rows are searched like others.
    """
    windows = benchmark_windows(benchmark.where(F.col(item_id).isNotNull()), item_id, item_text, length, gram)
    sizes = {r["_size"]: r["n"] for r in windows.groupBy("_size").agg(F.count("*").alias("n")).collect()}  # at most ``length`` rows
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("tag"),
                       token_words(F.col(text_col)).alias("_words"))
    rows = rows.withColumn("_placed", placed_hashes(F.col("_words"), length, gram))
    rows = rows.withColumn("_least", least_of_windows(F.col("_placed"), length - gram + 1))
    # Each row sends itself, so that rows without a hit stay, and its fingerprints with the words around them.
    itself = F.array(_probe(F.lit(0), F.shiftright("tag", PLACE_BITS), F.lit(0), F.lit(0), F.array().cast("array<string>"), F.size("_words")))
    sent = [itself, *([_long_probes(length, gram)] if length in sizes else []), *(_short_probes(s) for s in sorted(sizes) if s < length)]
    probes = rows.select("doc_id", "tag", F.explode(F.concat(*sent)).alias("_p")).select("doc_id", "tag", "_p.*")
    few = sum(sizes.values()) <= BROADCAST_WINDOWS
    pairs = probes.join(F.broadcast(windows) if few else windows.hint("merge"), ["_print", "_size"], "left")
    start = F.col("_at") - F.col("_inside")
    skip = start - F.col("_from")
    same = (skip >= 0) & (F.slice("_near", F.greatest(skip, F.lit(0)) + 1, F.col("_size")) == F.col("_window"))
    hit = F.when(same, F.struct(start.alias("start"), (start + F.col("_size")).alias("end")))
    found = pairs.where(same | (F.col("_size") == 0)).groupBy("doc_id", "tag").agg(
        F.max("_n").cast("long").alias("n_words"), F.count("_n").cast("int").alias("_copies"),
        F.collect_set(hit).alias("_hits"), F.collect_set("_items").alias("_sets"))
    items = F.array_sort(F.array_distinct(F.transform(F.flatten("_sets"), lambda x: x.cast("string"))))
    out = found.select("doc_id", "tag", "n_words", merged_runs(F.col("_hits")).alias("hits"), items.alias("items"), "_copies")
    return out.select("doc_id", "tag", "n_words", "hits", "items", F.explode(F.array_repeat(F.lit(0), F.col("_copies"))).alias("_copy")).drop("_copy")


def _probe(size: Column, mark: Column, at: Column, begin: Column, near: Column, n: Column | None = None) -> Column:
    return F.struct(size.alias("_size"), mark.alias("_print"), at.alias("_at"), begin.alias("_from"), near.alias("_near"),
                    (F.lit(None).cast("int") if n is None else n).alias("_n"))


def _long_probes(length: int, gram: int) -> Column:
    reach = length - gram  # a window holding the fingerprint begins at most so many words before it

    def probe(f: Column) -> Column:
        begin = F.greatest(place(f) - reach, F.lit(0))
        return _probe(F.lit(length), F.shiftright(f, PLACE_BITS), place(f), begin, F.slice("_words", begin + 1, F.lit(length + reach)))

    return F.transform("_least", probe)


def _short_probes(size: int) -> Column:
    def probe(h: Column, i: Column) -> Column:
        return _probe(F.lit(size), F.shiftright(F.shiftleft(h, PLACE_BITS), PLACE_BITS), i, i, F.slice("_words", i + 1, F.lit(size)))

    return F.transform(gram_hashes(F.col("_words"), size), probe)


def merged_runs(hits: Column) -> Column:
    """Maximal runs of the union of (start, end) pairs."""
    kind = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
    empty = F.struct(F.array().cast(kind).alias("done"), F.lit(None).cast("int").alias("start"), F.lit(None).cast("int").alias("end"))

    def run(start: Column, end: Column) -> Column:
        return F.array(F.struct(start.alias("start"), end.alias("end")))

    def step(a: Column, h: Column) -> Column:
        apart = a["end"].isNull() | (h["start"] > a["end"])
        return F.struct(F.when(apart & a["end"].isNotNull(), F.concat(a["done"], run(a["start"], a["end"]))).otherwise(a["done"]).alias("done"),
                        F.when(apart, h["start"]).otherwise(a["start"]).alias("start"),
                        F.when(apart, h["end"]).otherwise(F.greatest(a["end"], h["end"])).alias("end"))

    return F.aggregate(F.array_sort(hits), empty, step, lambda a: F.when(a["end"].isNull(), a["done"]).otherwise(F.concat(a["done"], run(a["start"], a["end"]))))


def clean_documents(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Rows of ``docs`` without any hit, all columns as they are."""
    found = find_contamination(docs, benchmark, id_col, text_col, **options).where(F.size("hits") > 0)
    path = scratch_path(docs.sparkSession, "contaminated")
    found.select(F.col("doc_id").alias("_hit_id"), F.col("tag").alias("_hit_tag")).distinct().write.parquet(path)
    hits = docs.sparkSession.read.parquet(path)
    small = hits.count() <= BROADCAST_HITS
    same = F.col(id_col).eqNullSafe(F.col("_hit_id")) & (F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))) == F.col("_hit_tag"))
    return docs.join(F.broadcast(hits) if small else hits.hint("merge"), same, "left_anti")
