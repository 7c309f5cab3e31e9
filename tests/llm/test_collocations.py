import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm import collocations as co
from quarry.llm import queries as Q


def counts(rows):
    """Phrase counts per language, and words."""
    found, total = {}, Counter()
    for lang, text in rows:
        lang = lang or "und" if lang is None else lang
        low = (text or "").translate({c: c + 32 for c in range(65, 91)})
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            for k in (1, 2, 3):
                found.setdefault(lang, Counter()).update(" ".join(w[i: i + k]) for i in range(len(w) - k + 1))
    return found, total


def brute(rows, least=10, percent=50, most=2000):
    found, total = counts(rows)
    out = []
    for lang, f in found.items():
        scored = []
        for g, a in f.items():
            w = g.split(" ")
            if len(w) < 2 or a < least:
                continue
            if len(w) == 2 and any(100 * n >= percent * a and n >= least for t, n in f.items() if t.count(" ") == 2 and f" {g} " in f" {t} "):
                continue
            cuts = []
            for k in range(1, len(w)):
                left, right = f[" ".join(w[:k])], f[" ".join(w[k:])]
                cuts.append((10**6 * a * a // (left * right), k, left, right))
            score, _, left, right = min(cuts)
            scored.append((-score, -a, g.encode(), left, right))
        for rank, (s, a, g, left, right) in enumerate(sorted(scored)[:most], 1):
            out.append((lang, rank, g.decode(), -a, left, right, total[lang], -s))
    return sorted(out)


def frame(spark, rows, parts):
    schema = T.StructType([T.StructField("lang", T.StringType()), T.StructField("text", T.StringType())])
    return spark.createDataFrame(rows, schema).repartition(parts).withColumn("phrase", F.lit("x")).withColumn("n", F.lit(7)).withColumn("key", F.lit(1))


def corpus(seed, n):
    rng = np.random.default_rng(seed)
    words = ["New", "york", "CITY", "the", "of", "x", "É", "state", "uníon", "a b", "-"]
    rows = []
    for i in range(n):
        text = ""
        for w in rng.choice(words, int(rng.integers(0, 60)), p=[0.2, 0.15, 0.1, 0.2, 0.1, 0.05, 0.05, 0.05, 0.04, 0.03, 0.03]):
            text += w + rng.choice([" ", "  ", "\t", ", ", "\n", ". ", " ? "], p=[0.7, 0.05, 0.05, 0.05, 0.05, 0.05, 0.05])
        rows.append((["en", None, "de", "und", ""][int(rng.integers(5))], text))
    return rows + [("en", None), (None, ""), ("fr", " .. "), (None, None)]


@pytest.mark.parametrize("shard,step", [(6_000_000, 1 << 20), (400, 1 << 20), (400, 16)])
def test_matches_brute_force_at_any_shard_size(spark, monkeypatch, shard, step):
    monkeypatch.setattr(co, "SHARD_BYTES", shard)
    monkeypatch.setattr(co, "STEP_WORDS", step)
    rows = corpus(3, 400)
    rows += [rows[0], rows[0]]
    for parts in (1, 7):
        got = sorted(tuple(r) for r in co.top_collocations(co.collocations(frame(spark, rows, parts))).collect())
        assert got == brute(rows) and len(got) > 20


def test_a_crowded_table_changes_nothing(spark):
    rows = corpus(5, 300)
    got = {(r.lang, r.phrase): r.n for r in co.phrase_counts(frame(spark, rows, 3), bits=6).where("words > 0").collect()}
    assert got == {(lang, g): n for lang, f in counts(rows)[0].items() for g, n in f.items() if n >= 10}


def test_local_supports_follow_the_share(spark):
    assert co.local_supports(["a", "b", "a"], np.array([30, 10, 10]), {"a": 100, "b": 1000}, 10) == {"a": 4, "b": 1}
    assert co.local_supports(["c"], np.array([5]), {}, 10) == {"c": 1}


def test_shards_report_only_what_reaches_the_local_support():
    batch = pa.RecordBatch.from_pydict({"lang": ["en"], "text": ["a b a b a b a c"]})
    (found,) = co._mine({"en": 30}, {"en": 4}, 6, [])(iter([batch]))  # half the language: a support of 3
    assert sorted(zip(found.column("n").to_pylist(), found.column("spare").to_pylist())) == [(1, 4), (2, 4)]


def test_phrases_across_steps_and_long_texts(spark, monkeypatch):
    monkeypatch.setattr(co, "STEP_WORDS", 1000)
    rows = [("en", "p q r " * 20_000), ("en", "z" * 200_000), ("en", " ".join(f"u{i}" for i in range(30_000)))]
    got = sorted(tuple(r) for r in co.top_collocations(co.collocations(frame(spark, rows, 2))).collect())
    assert got == brute(rows)


def test_hot_phrase_of_one_language(spark):
    docs = spark.range(6000).select(F.when(F.col("id") % 3 > 0, F.lit("xx")).alias("lang"), F.concat(F.lit("hot phrase here "), F.col("id") % 50).alias("text"))
    rows = [(r.lang, r.text) for r in docs.collect()]
    assert sorted(tuple(r) for r in co.top_collocations(co.collocations(docs)).collect()) == brute(rows)


def test_exact_scores_of_large_counts(spark):
    df = spark.createDataFrame([(99_999_999_999_977, 99_999_999_999_989, 99_999_999_999_999)], "a long, l long, r long")
    top = co._wide("a") * co._wide("a") * F.lit(1_000_000).cast("decimal(8,0)")
    got = df.select(top.alias("t"), (co._wide("l") * co._wide("r")).alias("b")).select(F.expr("t div b").alias("s")).first().s
    assert got == 10**6 * 99_999_999_999_977**2 // (99_999_999_999_989 * 99_999_999_999_999)


def test_empty_table_and_query(spark):
    assert co.collocations(frame(spark, [("en", "a b")], 1).limit(0)).count() == 0
    sf = "/root/testdata/sf0.001"
    rows = [(r.lang, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert sorted(tuple(r) for r in Q.QUERIES["op13_phrase_collocations"](spark, sf).collect()) == brute(rows)
