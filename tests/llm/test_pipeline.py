import importlib.util
import os

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from quarry.llm import quality_rules as qr

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SF = "/root/testdata/sf0.001"


def _load(name, path):
    spec = importlib.util.spec_from_file_location(name, path)
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    return module


cp = _load("corpus_pipeline", os.path.join(ROOT, "corpus_pipeline.py"))
HERE = os.path.dirname(os.path.abspath(__file__))
quality, jaccard, repeat, leaks = (_load(f"brute_{n}", os.path.join(HERE, f"test_{n}.py")) for n in ("quality_rules", "jaccard_join", "repeats", "decontaminate"))


def cut_words(text, want):
    """Text without the removed words (given by flags), each run with the space behind it."""
    spans = [m.span() for m in repeat.WORD.finditer(text.encode())]
    raw, out, at = text.encode(), [], 0
    for (a, _), gone, nxt in zip(spans, want, [*spans[1:], (len(raw), 0)]):
        if gone:
            out.append(raw[at:a])
            at = nxt[0]
    return b"".join([*out, raw[at:]]).decode()


def removed_flags(rows, window=50):
    words = {i: repeat.WORD.findall(t.encode()) for i, t in rows}
    first = {}
    for i in sorted(words):
        for p in range(len(words[i]) - window + 1):
            first.setdefault(tuple(words[i][p: p + window]), i)
    out = {}
    for i, w in words.items():
        flags = [False] * len(w)
        for p in range(len(w) - window + 1):
            if first[tuple(w[p: p + window])] < i:
                flags[p: p + window] = [True] * window
        out[i] = flags
    return out


def test_stages_match_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rules = qr.learn(qr.labelled_rows(docs, spark.read.parquet(f"{SF}/labels.parquet")))
    stats = {r.doc_id: r for r in qr.text_statistics(docs).select("doc_id", *(qr.ratio(n).alias(n) for n in qr.RATIOS)).collect()}
    texts = {d.doc_id: d.text for d in docs.collect()}
    texts = {i: t for i, t in texts.items() if not quality.brute(t)[-1] and not any(qr._covers(r, stats[i]) for r in rules)}
    for name, stage in cp.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == list(cp.COLUMNS), name
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        if name == "jaccard_join":
            label = near_copies(sorted(texts.items()))
            texts = {i: t for i, t in texts.items() if label[i] == i}
        if name == "substring_dedup":
            flags = removed_flags(sorted(texts.items()))
            texts = {i: cut_words(t, flags[i]) for i, t in texts.items() if not all(flags[i])}
        if name == "decontamination":
            items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            texts = {i: t for i, t in texts.items() if not leaks.brute(t, items)[1]}
        assert {r.doc_id: r.text for r in docs.collect()} == texts, name
    got = {}
    for r in sorted(cp.STAGES[-1][1](spark, docs, SF).collect(), key=lambda r: (r.doc_id, r.start)):
        got.setdefault(r.doc_id, []).extend(np.frombuffer(bytes(r.ids), dtype="<u4").tolist())
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    assert got == {i: t.encode(x, add_special_tokens=False).ids + [2] for i, x in texts.items()}
    assert 50 < len(got) < 200


def test_run_applies_all_stages(spark):
    out = cp.run(spark, SF)
    assert {"doc_id", "sequence_id", "ids"} <= set(out.columns) and out.count() > 200
    assert [n for n, _ in cp.STAGES] == ["quality_rules", "jaccard_join", "substring_dedup", "decontamination", "packing"]


def test_stages_on_empty_and_odd_tables(spark, documents):
    docs = documents([(1, None), (2, ""), (2, ""), (None, "a b " * 30), (3, " ".join(f"w{i}" for i in range(70)))]).select(*cp.COLUMNS)
    for table in (docs, docs.limit(0)):
        for _, stage in cp.STAGES:
            done = stage(spark, table, SF)  # each stage on a written table, as run() does
            table = spark.createDataFrame(done.collect(), done.schema)
        assert {r.doc_id for r in table.select("doc_id").distinct().collect()} <= {3, None}


def near_copies(rows, shingle=5, percent=80):
    """Least id of each row's group, from all pairs."""
    label = {i: i for i, _ in rows}
    words = [(i, jaccard.WORD.findall(t.lower())) for i, t in rows]
    sets = [(i, {tuple(w[k: k + shingle]) for k in range(max(1, len(w) - shingle + 1))} if w else set()) for i, w in words]
    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and label[i] != label[j] and 100 * len(a & b) >= percent * len(a | b):
                one, two = sorted((label[i], label[j]))
                label = {x: one if y == two else y for x, y in label.items()}
    return label


def test_near_copies_are_linked_from_four_fifths_of_five_word_shingles(spark, documents):
    base = [f"v{i}" for i in range(50)]
    near = base[:25] + ["other"] + base[26:]  # 41 of 51 shingles of five words, 43 of 51 of four
    rows = jaccard.corpus(4, 220) + [(9000, " ".join(base)), (9001, " ".join(near))]
    kept = {r.doc_id: r.text for r in cp.jaccard(spark, documents(rows, 4).select(*cp.COLUMNS), SF).collect()}
    label = near_copies(rows)
    assert kept == {i: t for i, t in rows if label[i] == i} and 9000 in kept and 9001 not in kept
    assert set(kept) != {i for i, x in jaccard.brute(rows).items() if i == x}


def test_clean_rows_of_null_or_shared_ids_stay(spark, documents):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    texts = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect() if r.text]
    clean = []
    for t in texts:
        if len(clean) < 5 and t not in clean and len(t.split()) > 100 and not quality.brute(t)[-1] and not leaks.brute(t, items)[1]:
            clean.append(t)
    a, b, c = 100_007, 100_009, 100_005  # not labelled
    rows = [(None, clean[0]), (None, clean[1]), (a, clean[2]), (a, clean[3]), (a, clean[3]), (b, clean[3]), (c, clean[4]), (None, clean[4])]
    table = documents(rows).select(*cp.COLUMNS)
    for name, stage in cp.STAGES:
        done = stage(spark, table, SF)
        table = spark.createDataFrame(done.collect(), done.schema)
        if name == "jaccard_join":
            assert {(r.doc_id, r.text) for r in table.collect()} == {(None, clean[0]), (None, clean[1]), (a, clean[2]), (a, clean[3]), (c, clean[4])}
            assert table.count() == 5
    assert sorted((r.doc_id for r in table.where("start = 0").collect()), key=str) == [c, a, a, None, None]


def test_all_queries_run_on_workers_without_the_package(tmp_path):
    """Loaded by path from another folder, with Python workers that cannot import the package."""
    import subprocess
    import sys
    code = (
        "import importlib.util\n"
        f"spec = importlib.util.spec_from_file_location('e', {os.path.join(ROOT, '__spark_entry__.py')!r})\n"
        "m = importlib.util.module_from_spec(spec); spec.loader.exec_module(m)\n"
        "from pyspark.sql import SparkSession\n"
        "s = SparkSession.builder.master('local[4]').config('spark.ui.enabled', 'false').config('spark.sql.shuffle.partitions', '4').getOrCreate()\n"
        "for n, q in sorted(m.queries().items()):\n"
        "    if n.startswith('op') and n[2].isdigit() or n == 'pipeline':\n"
        f"        print('ROWS', n, q(s, {SF!r}).count())\n"
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    done = [x.split()[1] for x in out.stdout.splitlines() if x.startswith("ROWS")]
    assert len(done) == 14 and "pipeline" in done, out.stderr[-2000:]
