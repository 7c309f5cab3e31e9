"""Document fingerprints after the manner of SpotSigs.

A signature starts at every common word (an anchor) and holds the next
``CHAIN`` content words behind it; words that are anchors themselves are passed
over. A fingerprint is the set of a text's signatures. Boilerplate without
running prose gets few anchors, and a changed passage only loses the
signatures that touch it, so the Jaccard likeness of two sets follows the text
they share. Set lengths bound that likeness from above (the shorter over the
longer), so a comparison whose lengths lie in partitions too far apart ends
before the sets are looked at.

Everything is a projection or a window of built-in functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.columns import MARKS

#: Content words of a signature.
CHAIN = 3
#: Common words of four languages.
ANCHORS = {
    "de": "als am an auch auf aus bei bis das dass dem den der des die durch ein eine einem einen einer er es für hat im in ist ich mit nach nicht noch nur oder sich sie sind so um und unter vom von vor war werden wie wird zu zum zur",
    "en": "a an and are as at be but by for from had has have he her his i in is it its not of on or she that the their they this to was we were which will with you",
    "es": "a al como con de del el ella en entre era es esta este fue ha hay la las le lo los más me mi no o para pero por que se sin sobre son su sus un una y ya",
    "fr": "a au aux avec ce ces cette comme dans de des du elle en est et il ils je la le les leur mais ne nous on ou par pas plus pour que qui sa se ses son sont sur un une vous",
}
#: Length partitions: set sizes whose ratio is at most this share one.
STEP = 0.8
#: Likeness under which two sets count as unlike (0); their lengths alone may show it.
LEAST = 0.05


def _once(df: DataFrame, *named: Column) -> DataFrame:
    """``df`` with further columns that come out of a generator, so that what
    is built on them refers to them and does not compute them again."""
    return df.select("*", F.inline(F.array(F.struct(*named))))


def with_signatures(df: DataFrame, text_col: str, out: str) -> DataFrame:
    """``df`` with the column ``out``: the ordered distinct signatures (64-bit
    hashes) of a text. Letters count as lower case.

    At the end of a text a chain may be shorter, one word at least. In a text
    without signatures every word starts a chain of its own; a text without
    words is its own signature; an empty or null text has none.
    """
    anchors = sorted({w for words in ANCHORS.values() for w in words.split()})
    t, a, c = (f"_{out}_{x}" for x in ("words", "anchors", "content"))
    text = F.btrim(F.lower(F.coalesce(F.col(text_col), F.lit(""))), F.lit(MARKS))
    words = F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"))
    # Words by their hash, anchors odd and others even: arrays of numbers go from step to step.
    even = lambda x: F.shiftleft(F.xxhash64(x), 1)
    found = _once(df, F.transform(words, lambda x: even(x) + F.when(x.isin(anchors), F.lit(1)).otherwise(F.lit(0))).alias(t))
    odd = lambda h: h.bitwiseAND(F.lit(1)) == 1
    spots = F.filter(F.transform(t, lambda h, i: F.when(odd(h), i).otherwise(F.lit(-1))), lambda i: i >= 0)
    found = _once(found, spots.alias(a), F.filter(t, lambda h: ~odd(h)).alias(c))
    # Of i words before an anchor, j are anchors: its chain starts at content word i - j.
    chain = lambda x, words, at: F.xxhash64(x, *(F.get(words, at + k) for k in range(CHAIN)))
    chains = F.filter(F.transform(a, lambda i, j: F.when(i - j < F.size(c), chain(F.get(t, i), F.col(c), i - j))), lambda h: h.isNotNull())
    found = _once(found, F.array_sort(F.array_distinct(chains)).alias(f"_{out}"))
    every = F.array_sort(F.array_distinct(F.transform(t, lambda h, i: chain(h, F.col(t), i + 1))))
    none = F.array().cast("array<bigint>")
    whole = F.when(F.size(t) > 0, every).when(F.col(text_col) != "", F.array(F.xxhash64(F.col(text_col)))).otherwise(none)
    return found.withColumn(out, F.when(F.size(f"_{out}") > 0, F.col(f"_{out}")).otherwise(whole)).drop(t, a, c, f"_{out}")


def fingerprint(signatures: str) -> Column:
    """Number of signatures and digest of the set; equal sets have equal fingerprints."""
    listed = F.array_join(F.transform(signatures, lambda h: h.cast("string")), ",")
    return F.concat(F.size(signatures).cast("string"), F.lit(":"), F.sha2(listed.cast("binary"), 256))


def length_partition(signatures: str, step: float = STEP) -> Column:
    """Number of the length partition; sizes p partitions apart differ by a factor of ``step**(p - 1)`` at least."""
    return F.when(F.size(signatures) > 0, F.floor(F.log(F.size(signatures).cast("double")) / F.log(F.lit(1 / step)))).otherwise(F.lit(-1)).cast("int")


def likeness(one: str, two: str, least: float = LEAST) -> Column:
    """Jaccard of two signature sets; 0 where it is under ``least``, 1 for two
    empty sets. Pruned by length partition and by length first."""
    import math

    small, large = F.least(F.size(one), F.size(two)), F.greatest(F.size(one), F.size(two))
    apart = math.ceil(math.log(1 / least) / math.log(1 / STEP)) + 1
    common = F.size(F.array_intersect(one, two))
    jaccard = common / (small + large - common)
    return (F.when(large == 0, F.lit(1.0))
            .when(F.abs(length_partition(one) - length_partition(two)) > apart, F.lit(0.0))
            .when(small < least * large, F.lit(0.0))
            .otherwise(F.when(jaccard >= least, jaccard).otherwise(F.lit(0.0))))


def dealt(docs: DataFrame, n_buckets: int | None = None) -> DataFrame:
    """``docs`` (doc_id, text) dealt to buckets of neighbouring ids, for ``next_values``.

    The order is by descending doc_id; rows that share an id follow the hash of
    their text (descending), null ids come last. Buckets are bounded by
    quantiles of the ids; each also gets a copy (``_copy`` 1) of the first row of
    the next one, and the last of the first, so that no window spans the table.
    The driver receives one id a bucket.
    """
    spark = docs.sparkSession
    n = n_buckets or max(8, 2 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    bounds = sorted(set(docs.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)], 100 * n)).first()[0] or []))
    # Null ids have 16 buckets of their own, by the leading bits of the hash.
    place = F.when(F.col("doc_id").isNull(), F.lit(len(bounds) + 8) - F.shiftright("_h", 60).cast("int")).otherwise(
        F.size(F.filter(F.array(*[F.lit(b) for b in bounds]).cast("array<bigint>"), lambda b: b > F.col("doc_id"))))
    rows = docs.withColumn("_h", F.xxhash64("text")).withColumn("_bucket", place)
    known = F.coalesce("doc_id", F.lit(0)).cast("bigint")
    first = F.max(F.struct(known.alias("i"), "_h")).alias("f")
    heads = sorted((r["_bucket"], r["f"]["i"], r["f"]["_h"]) for r in rows.groupBy("_bucket").agg(first).collect())
    # At most len(bounds) + 17 heads: id and hash of a bucket's first row, and the bucket before it.
    steps = [F.struct(F.lit(b).alias("_of"), F.lit(i).cast("bigint").alias("_i"), F.lit(h).cast("bigint").alias("_head"), F.lit(heads[k - 1][0]).alias("_before"))
             for k, (b, i, h) in enumerate(heads)]
    none = F.struct(F.lit(-1).alias("_of"), F.lit(0).cast("bigint").alias("_i"), F.lit(0).cast("bigint").alias("_head"), F.lit(-1).alias("_before"))
    table = spark.range(1).select(F.inline(F.array(*(steps or [none]))))
    same = (F.col("_bucket") == F.col("_of")) & (known == F.col("_i")) & (F.col("_h") == F.col("_head"))
    copies = rows.join(F.broadcast(table), same).select("doc_id", "text", "_h", F.col("_before").alias("_bucket")).dropDuplicates(["_bucket"])
    return rows.withColumn("_copy", F.lit(0)).unionByName(copies.withColumn("_copy", F.lit(1)))


def next_values(rows: DataFrame, carry: tuple[str, ...]) -> DataFrame:
    """The rows of ``dealt`` (without the copies), with ``next_<column>`` for
    each column of ``carry``: that of the next row in order, after the last of the first."""
    order = Window.partitionBy("_bucket").orderBy("_copy", F.col("doc_id").desc_nulls_last(), F.col("_h").desc())
    led = rows.select("*", *[F.lead(c).over(order).alias(f"next_{c}") for c in carry])
    return led.where("_copy = 0").drop("_copy", "_bucket", "_h")


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_chars, text, edited (the last third of the text replaced by the
    beginning of the next document), the signature sets signatures,
    edited_signatures and next_signatures, near_edited and near_next; one row
    per input row.

    A null text is empty. An only document is its own next one. Rows that share
    an id are documents of their own (``dealt`` states their order). An empty
    table gives none.
    """
    own = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    led = next_values(with_signatures(dealt(own), "text", "signatures"), ("text", "signatures"))
    led = led.withColumn("n_chars", F.length("text").cast("long"))
    cut = F.expr("cast(n_chars div 3 as int)")
    edited = F.concat(F.substr("text", F.lit(1), F.col("n_chars").cast("int") - cut), F.substr("next_text", F.lit(1), cut))
    led = _once(led.withColumn("_edit", edited), F.col("_edit").alias("edited")).drop("_edit", "next_text")
    led = with_signatures(led, "edited", "edited_signatures")
    return led.select("doc_id", "n_chars", "text", "edited", "signatures", "edited_signatures", "next_signatures",
                      likeness("signatures", "edited_signatures").alias("near_edited"), likeness("signatures", "next_signatures").alias("near_next"))
