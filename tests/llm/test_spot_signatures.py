import hashlib
import re

from pyspark.sql import functions as F

from quarry.llm import queries as Q
from quarry.llm import spot_signatures as sp

WORD = re.compile(r"(?:[0-9A-Za-z]|[^\x00-\x7f])+")
ANCHORS = {w for words in sp.ANCHORS.values() for w in words.split()}


def signatures(text):
    """Set of chains: an anchor and the content words behind it."""
    words = WORD.findall((text or "").lower())
    out = set()
    for i, w in enumerate(words):
        if w in ANCHORS:
            chain = [x for x in words[i + 1:] if x not in ANCHORS][: sp.CHAIN] if i + 1 < len(words) else []
            if chain:
                out.add((w, *chain))
    if not out:
        out = {tuple(words[i: i + sp.CHAIN + 1]) for i in range(len(words))}
    return out or ({text} if text else set())


def likeness(a, b):
    if not a and not b:
        return 1.0
    jaccard = len(a & b) / len(a | b)
    small, large = sorted((len(a), len(b)))
    return jaccard if jaccard >= sp.LEAST and small >= sp.LEAST * large else 0.0


def expected(rows):
    """Per row of (id, text), which are all different: n_chars, edited text and likenesses."""
    order = sorted(rows, key=lambda r: -r[0])
    out = {}
    for k, (i, text) in enumerate(order):
        text, after = text or "", order[(k + 1) % len(order)][1] or ""
        m = len(text) // 3
        edited = text[: len(text) - m] + after[:m]
        out[i] = (len(text), edited, likeness(signatures(text), signatures(edited)), likeness(signatures(text), signatures(after)))
    return out


TEXTS = [None, "", " \n", "The cat of the house sat on a mat", "THE Cat of the House sat on a Mat!", "one two three", "the", "the of and", "é the ñandú Ünder und über",
         "the cat " * 20_000, " ".join(f"w{i} the x{i}" for i in range(9000)), "w" * 50_000, "\U0001f600 the \U0001f601 smile of \U0001f602 faces", "...", "the the the cat"]


def check(out, rows):
    want = expected(rows)
    got = {r.doc_id: r for r in out.collect()}
    assert len(got) == len(rows)
    for i, (n, edited, near, after) in want.items():
        assert (got[i].n_chars, got[i].edited) == (n, edited), i
        assert abs(got[i].near_edited - near) < 1e-12 and abs(got[i].near_next - after) < 1e-12, i


def test_matches_brute_force_over_many_buckets(spark, documents):
    rows = [(7 * i + 3, t) for i, t in enumerate(TEXTS * 2)]
    check(sp.edited_fingerprints(documents(rows, 5)), rows)
    one = [(5, "only the one document of all")]
    check(sp.edited_fingerprints(documents(one, 1)), one)


def test_equal_texts_have_equal_fingerprints(spark, documents):
    out = sp.edited_fingerprints(documents(list(enumerate(TEXTS * 2)))).select("text", sp.fingerprint("signatures").alias("f"))
    sets = {}
    for r in out.collect():
        sets.setdefault(r.text, set()).add(r.f)
    assert all(len(f) == 1 for f in sets.values())
    assert sets["The cat of the house sat on a mat"] == sets["THE Cat of the House sat on a Mat!"] != sets["one two three"]


def test_query_on_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    rows = Q.QUERIES["op11_document_fingerprints"](spark, sf).collect()
    want = expected([(d.doc_id, d.text) for d in docs])
    assert {r.doc_id: (r.n_chars, r.edited_sha256) for r in rows} == {i: (n, hashlib.sha256(e.encode()).hexdigest()) for i, (n, e, *_) in want.items()}
    assert all(abs(r.near_edited - want[r.doc_id][2]) < 1e-12 and abs(r.near_next - want[r.doc_id][3]) < 1e-12 for r in rows)
    assert sum(r.near_edited > r.near_next for r in rows) > 0.9 * len(rows)


def test_null_and_shared_ids_and_empty_table(spark, documents):
    rows = [(None, "a null id"), (None, "of the other"), (4, "the same id"), (4, "as the other"), (4, "the same id")]
    out = sp.edited_fingerprints(documents(rows)).collect()
    assert sorted(map(str, ((r.doc_id, r.text) for r in out))) == sorted(map(str, rows))
    for r in out:
        m = len(r.text) // 3
        assert r.edited[: len(r.text) - m] == r.text[: len(r.text) - m]
        assert any(r.edited[len(r.text) - m:] == t[:m] for _, t in rows)
    assert sp.edited_fingerprints(documents(rows).limit(0)).count() == 0


def test_a_hot_text_takes_its_place_in_order(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit("the hot text of all")).otherwise(F.concat(F.lit("the text of "), "id")).alias("text"))
    led = sp.next_values(sp.dealt(docs, 40), ("doc_id",)).collect()
    assert {r.doc_id: r.next_doc_id for r in led} == {i: (i - 1) % 3000 for i in range(3000)}


def test_no_python_and_no_single_window(spark):
    plan = Q.QUERIES["op11_document_fingerprints"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "SinglePartition" not in plan and "Cartesian" not in plan


def test_lengths_prune_only_what_is_unlike(spark):
    rows = [(list(range(a)), list(range(a - c, a - c + b))) for a, b, c in [(0, 0, 0), (0, 3, 0), (5, 5, 5), (40, 2, 2), (41, 2, 2), (100, 90, 85), (1, 30, 1)]]
    df = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(rows)], "i int, x array<bigint>, y array<bigint>")
    got = {r.i: r.v for r in df.select("i", sp.likeness("x", "y").alias("v")).collect()}
    assert got == {i: likeness(set(x), set(y)) for i, (x, y) in enumerate(rows)}
