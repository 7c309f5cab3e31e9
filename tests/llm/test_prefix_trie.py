import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import prefix_trie as pt
from quarry.llm import queries as Q

SCHEMA = "conv_id long, turn long, role string, text string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def rebuilt(rows):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, (role or "").encode(), (text or "").encode()))
    convs = {c: [(r.decode(), t.decode()) for *_, r, t in sorted(x)] for c, x in convs.items()}
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - int(np.fmod(c, 20))
        out[c] = convs.get(base, [])[:h] + own[h:]
    return out


def brute(rows):
    nodes = {}
    for c, turns in rebuilt(rows).items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append((c, len(turns) == d))
    out = {}
    children = {}
    for path in nodes:
        if path:
            children.setdefault(path[:-1], []).append(path)
    for path in sorted(nodes, key=len, reverse=True):
        members = sorted(nodes[path])
        below = children.get(path, [])
        leaves = sum(out[p][5] for p in below) or 1
        saved = (len(members) - 1) * len(WORD.findall(path[-1][1])) if path else 0
        ends = ",".join(str(c) for c, end in members if end)
        up = min(c for c, _ in nodes[path[:-1]]) if path else None
        out[path] = (members[0][0], len(path), up, len(members), len(below), leaves, saved + sum(out[p][6] for p in below), hashlib.sha256(ends.encode()).hexdigest())
    return sorted(out.values(), key=str)


def trie(spark, rows, parts=4):
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts).withColumn("depth", F.lit(1)).withColumn("words", F.lit("x")).withColumn("_part", F.lit(3))
    return sorted((tuple(r) for r in pt.conversation_trie(df).collect()), key=str)


def conversations(seed, n):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        c = rng.choice([rng.randrange(200), -rng.randrange(60), 10**12 + rng.randrange(40)])
        for _ in range(rng.randrange(1, 6)):
            rows.append((c, rng.choice([None, *range(8)]), rng.choice(["user", "bot", None, ""]), rng.choice(["hi", "hi there", "", None, "a b  c", "é x"])))
    return rows


def test_matches_brute_force(spark):
    for seed in (1, 2):
        rows = conversations(seed, 150)
        rows += rows[:10] + [(None, 1, "user", "no conversation")]
        assert trie(spark, rows) == brute(rows)


def test_heads_of_other_conversations_and_turnless_ones(spark):
    ids = [0, 3, 7, 11, 20, 25, 41, 47, 63]  # no conversations 40 and 60
    rows = [(c, t, "user", f"turn {t}") for c in ids for t in range(c % 3 + 1)]
    assert any(not x for x in rebuilt(rows).values())
    assert trie(spark, rows) == brute(rows)


def test_a_conversation_of_a_third_of_all_rows_and_a_hot_first_turn(spark):
    rows = [(100, t, "user", f"long {t}") for t in range(1500)] + [(c, t, "user", "hello all" if t == 0 else f"t{c % 7}") for c in range(1000, 2000) for t in range(3)]
    rows += [(c, t, "user", f"long {t}") for c in (104, 2000, 2020) for t in range(700)]
    assert trie(spark, rows, 9) == brute(rows)


def test_long_texts_and_empty_table(spark):
    rows = [(1, 0, "user", "word " * 60_000), (2, 0, "user", "word " * 60_000), (3, 0, None, None), (3, None, None, None)]
    assert trie(spark, rows) == brute(rows)
    assert pt.conversation_trie(spark.createDataFrame([], SCHEMA)).count() == 0


def test_a_deep_chain_of_runs_takes_few_rounds(spark):
    rows = [(1000 * 20 + 20 * k, t, "user", f"step {t}") for k in range(40) for t in range(k + 4)]
    assert trie(spark, rows) == brute(rows)


def test_running_products_are_those_of_a_loop(spark):
    rows = [(g, i, random.Random(g * 100 + i).getrandbits(63), i) for g, n in ((1, 500), (2, 3), (5, 1)) for i in range(n)]
    scan = pt.Running(spark.createDataFrame(rows, "g long, i long, x long, y long").repartition(5), "g", [F.col("i")], ("x", "y"), (pt.BASES[0], 1))
    got = {(r.g, r.i): (r["at"], r.a1 & pt._WORD, r.a2, r.b1 & pt._WORD, r.b2) for r in scan.select("i").collect()}
    a = b = last = None
    for g, i, x, y in sorted(rows):
        a, b = (0, 0) if g != last else (a, b)
        want = (i + 1, (a * pt.BASES[0] + x) & pt._WORD, b + y, a, b)
        assert got[g, i] == want
        a, b, last = want[1], want[2], g


def test_colliding_products_are_found(spark, monkeypatch):
    rows = [(c, t, "user", f"{c} {t}") for c in range(60) for t in range(3)]
    monkeypatch.setattr(pt, "BASES", (1, 1))
    weak = lambda seed, *c: F.lit(1).cast("long")
    monkeypatch.setattr(pt.F, "xxhash64", weak)  # every turn looks the same
    with pytest.raises(RuntimeError):
        pt.conversation_trie(spark.createDataFrame(rows, SCHEMA))


def test_query_matches_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert sorted((tuple(r) for r in Q.QUERIES["op12_conversation_trie"](spark, sf).collect()), key=str) == brute(rows)
