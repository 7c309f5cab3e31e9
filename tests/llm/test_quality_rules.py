import re

from quarry.llm import quality_rules as qr
from quarry.llm import queries as Q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    grams = {}
    for i in range(len(words) - 7):
        grams.setdefault(tuple(words[i: i + 8]), []).append(i)
    inside = {j for at in grams.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
    n = len(words)
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(inside), n < 20 or 100 * len(inside) > 30 * n)


TEXTS = [None, "", " \n\t", "a b c", "x\ny\nx\n \n \nx", "a " * 30, "a b c d e f g h " * 3 + "z", "#$ %& |<> **\u00a0é \U0001f600 w\x0bv\x0cu",
         "one two three four five six seven eight nine one two three four five six seven eight", "w" * 100_000,
         " ".join(map(str, range(30_000))), "p q r s t u v w " * 9_000, "\r\n".join(["line a", "line a", "line b"]), "a\x1cb\u2028c d"]


def test_statistics_match_brute_force(spark, documents):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(5, TEXTS[5]), (None, "null id here")]
    out = qr.text_statistics(documents(rows)).withColumn("failed", qr.base_failed()).collect()
    assert len(out) == len(rows)
    for r in out:
        text = "null id here" if r.doc_id is None else TEXTS[r.doc_id]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.failed) == brute(text), r.doc_id


def test_query_matches_brute_force_and_keeps_good_text(spark):
    sf = "/root/testdata/sf0.01"
    rows = Q.QUERIES["op8_quality_rules"](spark, sf).collect()
    texts = {d.doc_id: d.text for d in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert len(rows) == len(texts)
    good = bad = good_kept = bad_kept = 0
    for r in rows:
        got = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
        assert got == brute(texts[r.doc_id]), r.doc_id
        assert r.kept == (not r.base_failed and r.bad_rule is None)
        if r.doc_id in labels and not r.base_failed:
            good += labels[r.doc_id]
            bad += 1 - labels[r.doc_id]
            good_kept += labels[r.doc_id] and r.kept
            bad_kept += (1 - labels[r.doc_id]) and r.kept
    assert good_kept >= 0.99 * good and bad_kept <= 0.3 * bad


def test_rules_are_learned_and_pruned():
    row = lambda c, s: {n: 0.0 for n in qr.RATIOS} | {"capitals_per_char": c, "symbols_per_word": s}
    rows = [(row(0.9, i % 7), True) for i in range(60)] + [(row(0.1, i % 7), False) for i in range(200)]
    rules = qr.learn(rows)
    assert len(rules) == 1 and len(rules[0]) == 1
    assert rules[0][0].feature == "capitals_per_char" and 0.1 < rules[0][0].threshold < 0.9
    assert qr.learn([(row(0.5, 1), i % 2 == 0) for i in range(50)]) == []
    assert qr.learn([(row(0.5, 1), False)] * 9) == [] and qr.learn([]) == []


def test_without_labels_and_empty_tables(spark, documents):
    docs = documents([(1, "a b"), (2, " ".join(map(str, range(40)))), (2, None)])
    labels = spark.createDataFrame([(None, 0, 1), (2, None, 0)], "doc_id long, quality int, toxic int")
    got = sorted((r.doc_id, r.n_words, r.kept) for r in qr.judge_quality(docs, labels).collect())
    assert got == [(1, 2, False), (2, 0, False), (2, 40, True)]
    assert qr.judge_quality(docs.limit(0), labels.limit(0)).count() == 0


def test_a_filter_on_the_verdict_stays_linear_in_the_text(spark, documents):
    """The counts are not computed again for every window when a caller filters on them."""
    import time

    docs = documents([(i, " ".join(f"w{(i * k) % 977}" for k in range(2000))) for i in range(1, 9)])
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    began = time.time()
    kept = {r.doc_id for r in qr.judge_quality(docs, labels).where("kept").collect()}
    assert time.time() - began < 60
    assert kept == {r.doc_id for r in qr.judge_quality(docs, labels).collect() if r.kept}
