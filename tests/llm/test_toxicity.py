import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quarry.llm import kernels as kn
from quarry.llm import queries as Q
from quarry.llm import toxicity as tx


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    rows = Q.QUERIES["op4_toxicity"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").collect()
    y = np.array([r.toxic for r in rows])
    got = np.array([r.predicted for r in rows])
    score = np.array([r.score for r in rows])
    assert ((got == 1) == (score >= 0.5)).all() and score.min() >= 0 and score.max() <= 1
    caught, right = (got[y == 1] == 1).mean(), y[got == 1].mean()
    print("recall", caught, "precision", right)
    assert caught > 0.9 and right > 0.9


def test_logits_of_a_slice_match_single_texts():
    rng = np.random.default_rng(1)
    model = tx.new_model(1)
    model.embeddings[:50] = rng.normal(0, 1, (50, tx.SIZE))
    model.biases[:] = rng.normal(0, 1, len(model.biases))
    lengths = [3, 0, 1, 2, 40, 0]
    rows = np.concatenate([[0], np.cumsum(lengths)])
    words, heads = rng.integers(0, 50, rows[-1]), rng.integers(0, 50, rows[-1])
    got = tx.logits(model, words, heads, rows)
    for i, n in enumerate(lengths):
        x = np.concatenate([model.embeddings[words[rows[i]: rows[i + 1]]] + model.embeddings[heads[rows[i]: rows[i + 1]]], np.zeros((2, tx.SIZE))])
        pooled = []
        for k, f in enumerate(model.filters):
            for c in range(tx.FILTERS):
                b = model.biases[k * tx.FILTERS + c]
                pooled.append(max([0.0, *(sum(x[t + j] @ f[j, :, c] for j in range(len(f))) + b for t in range(n))]))
        assert got[i] == pytest.approx(np.dot(pooled, model.weights) + model.bias, rel=1e-4, abs=1e-4)


def test_training_tells_a_phrase_apart():
    rng = np.random.default_rng(2)
    samples = []
    for i in range(200):
        words = rng.integers(100, 400, rng.integers(5, 40)).astype(np.int32)
        if i % 2:
            words[rng.integers(0, len(words))] = 7
        samples.append((words, words + 1000, i % 2))
    model = tx.train(samples)
    right = [(tx.logits(model, w, h, np.array([0, len(w)]))[0] > 0) == y for w, h, y in samples]
    assert np.mean(right) > 0.97
    assert not model.embeddings[5000:].any()


def test_threshold_and_calibration():
    assert tx.best_threshold(np.array([3.0, 2, 1, 0]), np.array([1, 1, 0, 0])) == 1.5
    assert tx.best_threshold(np.array([1.0, 1, 1]), np.array([1, 1, 0])) == 0.0
    model = tx.new_model()
    y = np.tile([0, 1], 20)
    tx.calibrate(model, np.concatenate([y[:20] * 2.0, y[20:] * 2.0 + 10]), y, np.repeat([0, 1], 20))
    assert model.thresholds[0] == 1.0 and model.thresholds[1] == 11.0


def test_language_from_function_words():
    texts = pa.array(["the cat and the dog", "el perro y la casa de los", "der Hund und die Katze", "les chats et la maison du roi pour qui", None, "zzz"])
    assert tx.word_ids(texts, kn.Powers())[3].tolist() == [1, 2, 0, 3, 4, 4]


def test_odd_rows_and_no_labels(spark, documents):
    docs = documents([(1, None), (1, None), (None, ""), (2, "x " * 50_000), (3, "\n")]).withColumn("score", F.lit(9)).withColumn("label", F.lit(1))
    model = tx.fit(docs, spark.createDataFrame([(1, None), (None, 1), (2, 1)], "doc_id long, toxic int"))
    rows = tx.score_toxicity(docs, model).collect()
    assert len(rows) == 5 and all(0 <= r.score <= 1 for r in rows)
    assert tx.score_toxicity(docs.limit(0), model).count() == 0


def test_all_labelled_texts_count(spark, documents, monkeypatch):
    """Every labelled text is read, whole: also those after the first thousands, and long ones."""
    monkeypatch.setattr(tx, "SHARD_TEXTS", 100)
    docs = documents([(i, f"w{i % 17} w{i % 13} " * (3000 if i % 100 == 0 else 2) + ("foul" if i % 3 == 0 else "fair")) for i in range(600)])
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(600)], "doc_id long, toxic int")
    stored = tx._labelled(docs, labels, "toxic")
    assert stored.count() == 600 and stored.select("shard").distinct().count() == 6
    assert stored.selectExpr("max(length(words))").first()[0] == 4 * 6001
    assert tx._labelled(docs.unionByName(docs), labels, "toxic").count() == 600
    rows = tx.score_toxicity(docs, tx.fit(docs, labels)).collect()
    right = [(r.score >= 0.5) == (r.doc_id % 3 == 0) for r in rows]
    assert np.mean(right) > 0.97
    again = tx.score_toxicity(docs, tx.fit(docs.repartition(7), labels)).collect()
    assert sorted((r.doc_id, r.score) for r in rows) == sorted((r.doc_id, r.score) for r in again)


def test_thresholds_by_spark_match_the_small_ones(spark):
    rng = np.random.default_rng(5)
    value, label, language = np.round(rng.normal(size=400), 1), rng.integers(0, 2, 400), rng.integers(0, 3, 400)
    got = tx.thresholds(spark.createDataFrame(list(zip(language.tolist(), label.tolist(), value.tolist())), "language long, label int, value double"))
    for k in (-1, 0, 1, 2):
        own = language == k if k >= 0 else np.ones(400, dtype=bool)
        assert got[k] == (label[own].sum(), (1 - label[own]).sum(), pytest.approx(tx.best_threshold(value[own], label[own])))
