import random
import re

import pytest
from pyspark.sql import functions as F

from quarry.llm import decontaminate as dc

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = {c: c + 32 for c in range(65, 91)}


def words(text):
    return WORD.findall((text or "").translate(LOW))


def brute(text, items, length=10):
    w = words(text)
    hit, found = set(), set()
    for item, own in items:
        v = words(own)
        size = min(len(v), length)
        grams = {tuple(v[i: i + size]) for i in range(len(v) - size + 1)} if v else set()
        for i in range(len(w) - size + 1):
            if tuple(w[i: i + size]) in grams:
                hit.update(range(i, i + size))
                found.add(str(item))
    return len(w), len(hit), sorted(found)


def case(seed, short):
    rng = random.Random(seed)
    word = lambda: rng.choice(["Éa", "b", "C3", "ñandú", "the", "中"]) + str(rng.randrange(3))
    items = [(i, " ".join(word() for _ in range(rng.randrange(10, 40)))) for i in range(12)]
    items += [(100, items[0][1]), (101, None), (102, "!!"), (103, "z " * 30)]
    if short:
        items += [(200, "uno dos TRES"), (201, "solo"), (202, "uno, dos tres cuatro")]
    docs = []
    for i in range(60):
        w = [word() for _ in range(rng.randrange(80))]
        for _ in range(rng.randrange(3)):
            own = (rng.choice(items)[1] or "").split()
            a = rng.randrange(len(own) + 1)
            at = rng.randrange(len(w) + 1)
            w[at:at] = own[a: a + rng.randrange(25)]
        docs.append((i, rng.choice([" ", "... ", "\n-"]).join(x.upper() if rng.random() < 0.1 and x.isascii() else x for x in w)))
    docs += [(1000, None), (1001, ""), (1002, "?!"), (1003, "z " * 5000), (1004, "UNO dos;tres"), (1005, "solo"), (1006, items[3][1])]
    return docs, items


@pytest.mark.parametrize("seed,short,most", [(1, False, 100_000), (2, True, 100_000), (3, True, 0)])
def test_matches_brute_force(spark, documents, monkeypatch, seed, short, most):
    monkeypatch.setattr(dc, "BROADCAST_WINDOWS", most)
    docs, items = case(seed, short)
    bench = spark.createDataFrame(items + [(None, items[1][1])], "item_id long, text string").withColumn("doc_id", F.lit(3))
    got = dc.find_contamination(documents(docs), bench).collect()
    assert len(got) == len(docs)
    texts = dict(docs)
    for r in got:
        ends = [h.end for h in r.hits]
        assert all(a < b.start for a, b in zip(ends, r.hits[1:]))
        assert (r.n_words, sum(h.end - h.start for h in r.hits), list(r["items"])) == brute(texts[r.doc_id], items), r.doc_id
    assert sum(bool(r.hits) for r in got) > 10


def test_every_shared_span_is_found_at_the_boundary(spark, documents):
    item = " ".join(f"w{i}" for i in range(30))
    docs = [(n, "x " * 3 + " ".join(f"w{i}" for i in range(5, 5 + n)) + " y") for n in range(8, 13)]
    got = {r.doc_id: [tuple(h) for h in r.hits] for r in dc.find_contamination(documents(docs), spark.createDataFrame([(1, item)], "item_id long, text string")).collect()}
    assert got == {8: [], 9: [], 10: [(3, 13)], 11: [(3, 14)], 12: [(3, 15)]}


def test_repeated_rows_null_ids_and_empty_tables(spark, documents):
    item = spark.createDataFrame([(1, "a b c d e f g h i j k")], "item_id long, text string")
    docs = documents([(4, "a b c d e f g h i j"), (4, "a b c d e f g h i j"), (4, "other"), (None, "q a b c d e f g h i j")])
    got = sorted((r.doc_id or 0, r.n_words, len(r.hits)) for r in dc.find_contamination(docs, item).collect())
    assert got == [(0, 11, 1), (4, 1, 0), (4, 10, 1), (4, 10, 1)]
    assert dc.find_contamination(docs.limit(0), item).count() == 0
    assert [len(r.hits) for r in dc.find_contamination(docs, item.limit(0)).collect()] == [0] * 4
