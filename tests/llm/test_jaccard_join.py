import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quarry.llm import components, jaccard_join as jj
from quarry.llm import kernels as kn
from quarry.llm import queries as Q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    w = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    return {tuple(w[i: i + 4]) for i in range(len(w) - 3)} if len(w) >= 4 else ({tuple(w)} if w else set())


def brute(rows):
    """n_shingles by row and component by id, from all pairs."""
    parent = {}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a
    sets = [(i, shingles(t)) for i, t in rows if i is not None]
    for i, _ in sets:
        parent[i] = i
    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= 85 * len(a | b):
                one, two = sorted((find(i), find(j)))
                parent[two] = one
    return {i: find(i) for i in parent}


def corpus(seed, n):
    rng = random.Random(seed)
    common = [f"c{i}" for i in range(40)]
    texts = []
    for i in range(n):
        kind = rng.random()
        if texts and kind < 0.6:
            w = list(rng.choice(texts))
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 6])):
                if w:
                    at = rng.randrange(len(w))
                    w[at: at + rng.randrange(2)] = [f"n{rng.randrange(500)}"] * rng.randrange(2)
        elif kind < 0.7:
            w = [f"n{rng.randrange(500)}" for _ in range(rng.randrange(12))] + common
        else:
            w = [f"n{rng.randrange(500)}" for _ in range(rng.choice([0, 1, 2, 3, 4, 5, 9, 30, 80, 95, 130, 300]))]
        texts.append(w)
    return [(7 * i + 2, rng.choice([" ", "\n", "  "]).join(x.upper() if rng.random() < .05 else x for x in w)) for i, w in enumerate(texts)]


@pytest.mark.parametrize("seed,flush,most", [(1, 2_000_000, 16 << 20), (2, 300, 0)])
def test_components_match_all_pairs(spark, documents, monkeypatch, seed, flush, most):
    monkeypatch.setattr(jj, "FLUSH", flush)
    monkeypatch.setattr(jj, "BROADCAST_BYTES", most)
    rows = corpus(seed, 220)
    rng = random.Random(seed)
    rng.shuffle(rows)
    rows += [(100_000, None), (100_001, ""), (100_002, " \n"), (rows[0][0], rows[0][1]), (rows[1][0], rows[2][1]), (None, rows[3][1]), (-4, rows[5][1])]
    want = brute(rows)
    got = jj.similarity_classes(documents(rows, 4)).collect()
    assert len(got) == len(rows)
    texts = {}
    for i, t in rows:
        texts.setdefault(i, []).append(len(shingles(t)))
    for r in got:
        assert r.n_shingles in texts[r.doc_id]
        assert r.component_id == (None if r.doc_id is None else want[r.doc_id]), r
    assert len(set(want.values())) < len(want) - 40


def test_links_missed_by_the_early_round_are_found(spark, documents, monkeypatch):
    from pyspark.sql import types as T
    none = T.StructType([T.StructField(c, T.LongType()) for c in ("x_doc", "x_tag", "y_doc", "y_tag")])
    monkeypatch.setattr(jj, "_early_pairs", lambda sets: sets.sparkSession.createDataFrame([], none))
    rows = corpus(3, 150)
    want = brute(rows)
    for r in jj.similarity_classes(documents(rows)).collect():
        assert r.component_id == want[r.doc_id]


def test_required_overlap_is_the_least():
    for a in range(1, 60):
        for b in range(1, 60):
            least = next((i for i in range(min(a, b) + 1) if 100 * i >= 85 * (a + b - i)), None)
            if least is not None:
                assert jj.required_pair(np.int64(a), np.int64(b)) == least and jj.required(np.int64(a)) <= least


def test_long_texts_are_cut_without_losing_shingles(monkeypatch):
    text = pa.array([" ".join(f"w{i % 61}" for i in range(5000)), "a b", "x y z w v"])
    whole = jj.shingle_sets(text, kn.Powers())
    monkeypatch.setattr(kn, "SLICE_BYTES", 700)
    cut = jj.shingle_sets(text, kn.Powers())
    assert [s.tolist() for s in whole] == [s.tolist() for s in cut] and [len(s) for s in whole] == [61, 1, 2]


def test_components(spark):
    edges = [(1, 2), (2, 3), (9, 8), (5, 5)] + [(100 + i, 101 + i) for i in range(40)] + [(500, 1000 + i) for i in range(30)]
    got = {r.node: r.label for r in components.component_minimum(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got[3] == 1 and got[9] == 8 and got[140] == 100 and got[1029] == 500 and 5 not in got
    assert components.component_minimum(spark.createDataFrame([], "a long, b long")).count() == 0


def test_empty_table_and_clashing_columns(spark, documents):
    docs = documents([(1, "a b c d e")]).withColumn("component_id", F.lit(0)).withColumn("class", F.lit("x")).withColumn("tag", F.lit(1))
    assert [tuple(r) for r in jj.similarity_classes(docs).collect()] == [(1, 2, 1)]
    assert jj.similarity_classes(docs.limit(0)).count() == 0


def test_query_matches_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(d.doc_id, d.text) for d in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want = brute(rows)
    texts = dict(rows)
    for r in Q.QUERIES["op7_jaccard_join"](spark, sf).collect():
        assert (r.n_shingles, r.component_id) == (len(shingles(texts[r.doc_id])), want[r.doc_id])
