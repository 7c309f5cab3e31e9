"""Byte and word repeats against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import kernels as kn
from quarry.llm import queries as Q
from quarry.llm import repeats, substring_dedup, suffix_dedup

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def brute_bytes(rows, length):
    raw = {i: (t or "").encode() for i, t in rows}
    first = {}
    for i in sorted(raw):
        for p in range(len(raw[i]) - length + 1):
            first.setdefault(raw[i][p: p + length], (i, p))
    out = {}
    for i, b in raw.items():
        gone = np.zeros(len(b) + 1, dtype=bool)
        for p in range(len(b) - length + 1):
            if first[b[p: p + length]] < (i, p):
                gone[p: p + length] = True
        runs = int((gone[:-1] & ~np.concatenate([[False], gone[:-1]])[:-1]).sum())
        out[i] = (len(b), int(gone.sum()), runs, bytes(b[j] for j in range(len(b)) if not gone[j]))
    return out


def brute_words(rows, window):
    words = {i: WORD.findall((t or "").encode()) for i, t in rows}
    first = {}
    for i in sorted(words):
        for p in range(len(words[i]) - window + 1):
            first.setdefault(tuple(words[i][p: p + window]), i)
    out = {}
    for i, w in words.items():
        gone = set()
        for p in range(len(w) - window + 1):
            if first[tuple(w[p: p + window])] < i:
                gone.update(range(p, p + window))
        out[i] = (len(w), len(gone), b" ".join(x for j, x in enumerate(w) if j not in gone).decode())
    return out


def corpus(seed, n, size, vocabulary=400):
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefgéß中") * rng.randint(1, 3) + str(rng.randrange(vocabulary))
    texts = []
    for _ in range(n):
        words = [word() for _ in range(rng.randrange(size))]
        for _ in range(rng.randrange(3)):
            if texts and (old := rng.choice(texts)):
                a = rng.randrange(len(old))
                cut = rng.randrange(len(words) + 1)
                words[cut:cut] = old[a: a + rng.randrange(size)]
        texts.append(words)
    out = [(10 * i + 3, rng.choice([" ", "  ", "\n", " \t"]).join(w)) for i, w in enumerate(texts)]
    out += [(1_000_001, "x" * 900), (1_000_002, "y" + "x" * 300), (1_000_003, None), (1_000_004, ""), (1_000_005, "ab " * 200), (1_000_006, " \n"),
            (1_000_007, "p q r s t u v " * 60), (-5, out[n // 2][1]), (1_000_008, out[n // 3][1] + " tail")]
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("seed,length,flush", [(1, 100, 2_000_000), (2, 30, 50), (3, 100, 300)])
def test_bytes_match_brute_force(spark, documents, monkeypatch, seed, length, flush):
    monkeypatch.setattr(repeats, "FLUSH", flush)
    rows = corpus(seed, 60, 120)
    want = brute_bytes(rows, length)
    got = suffix_dedup.remove_repeated_bytes(documents(rows, 5), length=length).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept)) == want[r.doc_id], r.doc_id
    assert sum(r.n_removed for r in got) > 1000


@pytest.mark.parametrize("seed,window,bits,flush", [(4, 50, 26, 2_000_000), (5, 8, 20, 60), (6, 20, 18, 500)])
def test_words_match_brute_force(spark, documents, monkeypatch, seed, window, bits, flush):
    monkeypatch.setattr(repeats, "FLUSH", flush)
    rows = corpus(seed, 60, 150)
    want = brute_words(rows, window)
    got = substring_dedup.remove_repeated_windows(documents(rows, 5), window=window, sketch_bits=bits).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_words, r.n_removed, r.kept) == want[r.doc_id], r.doc_id
    assert sum(r.n_removed for r in got) > 200


def test_kept_text_without_joining(spark, documents):
    body = " ".join(f"w{i}" for i in range(20))
    rows = [(1, body), (2, "head\n\n" + body + "\nmiddle  end"), (3, "a\tb\n")]
    got = {r.doc_id: r for r in substring_dedup.remove_repeated_windows(documents(rows), window=10, join_words=False).collect()}
    assert [got[i].kept for i in (1, 2, 3)] == [body, "head\n\nmiddle  end", "a\tb\n"]
    assert [tuple(s) for s in got[2].spans] == [(1, 21)]


def test_rows_that_share_an_id_null_ids_and_empty_tables(spark, documents):
    body = " ".join(f"w{i}" for i in range(80))
    rows = [(7, body), (7, body), (7, "x " + body), (None, body), (9, body)]
    got = sorted(substring_dedup.remove_repeated_windows(documents(rows)).collect(), key=lambda r: (r.doc_id or 0, r.n_words))
    assert [(r.doc_id, r.n_removed) for r in got] == [(None, 0), (7, 0), (7, 0), (7, 0), (9, 80)]
    got = suffix_dedup.remove_repeated_bytes(documents(rows)).collect()
    assert len(got) == 5 and [r.n_removed for r in got if r.doc_id is None] == [0]
    assert [r.n_removed for r in got if r.doc_id == 9] == [len(body)]
    empty = documents(rows).limit(0)
    assert suffix_dedup.remove_repeated_bytes(empty).count() == 0
    assert substring_dedup.remove_repeated_windows(empty).count() == 0


def test_long_inputs_are_cut_without_losing_windows(monkeypatch):
    monkeypatch.setattr(kn, "SLICE_BYTES", 500)
    rng = np.random.default_rng(0)
    tokens = kn.mix(rng.integers(0, 3, 4000).astype(np.uint64))
    off = np.array([0, 0, 120, 130, 4000])
    row, start, count, trigger, _ = kn.windows_by_minimizer(tokens, off, 40, 7, kn.Powers())
    seen = {(r, s + j) for r, s, c in zip(row, start, count) for j in range(c)}
    assert seen == {(r, p) for r in range(4) for p in range(off[r + 1] - off[r] - 39)} and sum(count) == len(seen)
    by_window = {}
    for r, s, c, t in zip(row, start, count, trigger):
        for j in range(c):
            w = tokens[off[r] + s + j: off[r] + s + j + 40].tobytes()
            assert by_window.setdefault(w, t) == t


def test_sketch_never_underestimates(spark, documents):
    rows = corpus(9, 40, 200)
    spec = repeats.Windows(words=True, length=20, gram=5, within=False)
    source = repeats.keyed(documents(rows, 7), "doc_id", "text")
    for bits in (18, 20):
        hot = substring_dedup.repeated_cells(source, spec, bits)
        import pyarrow as pa
        part = pa.RecordBatch.from_pydict({"doc_id": [i for i, _ in rows], "tag": [0] * len(rows), "text": pa.array([t for _, t in rows], pa.string())})
        triggers = repeats.phrases(part, spec, kn.Powers())["trigger"]
        values, n = np.unique(triggers, return_counts=True)

        class Shared:
            value = hot
        passed = substring_dedup._likely(Shared, bits, 2)(values)
        assert passed[n >= 2].all() and passed[n == 1].mean() < 0.2


def test_queries_match_brute_force_on_given_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(d.doc_id, d.text) for d in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want = brute_words(rows, 50)
    for r in Q.QUERIES["op3_substring_dedup"](spark, sf).collect():
        n, gone, kept = want[r.doc_id]
        assert (r.n_words, r.n_removed, r.kept_sha256) == (n, gone, hashlib.sha256(kept.encode()).hexdigest())
    want = brute_bytes(rows, 100)
    for r in Q.QUERIES["op2_suffix_dedup"](spark, sf).collect():
        n, gone, runs, kept = want[r.doc_id]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (n, gone, runs, hashlib.sha256(kept).hexdigest())


def test_hot_passage_leaves_each_task_once():
    n = 1000
    x = {"trigger": np.full(n, 5, np.uint64), "whole": np.arange(n).astype(np.uint64) // 500, "doc": np.arange(n), "tag": np.zeros(n, np.uint32),
         "start": np.zeros(n, np.uint32), "count": np.ones(n, np.uint16)}
    by_kind = {}
    for kind, part in repeats._settle(x, True, True, final=False):
        by_kind[kind] = by_kind.get(kind, 0) + len(part["doc"])
    assert by_kind == {repeats.SEND: 2, repeats.REPEAT: 998, repeats.EDGE: 2}


def test_clashing_columns_are_ignored(spark, documents):
    docs = documents([(1, "a")]).withColumn("starts", F.lit(1)).withColumn("tag", F.lit("t")).withColumn("kept", F.lit(0))
    assert suffix_dedup.remove_repeated_bytes(docs).columns == ["doc_id", "n_bytes", "n_removed", "spans", "kept"]
    assert substring_dedup.remove_repeated_windows(docs).count() == 1
