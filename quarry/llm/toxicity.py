"""Toxicity: a convolutional text classifier trained in numpy.

A word is the sum of two hashed embeddings, of the word and of its first four
bytes. Filters of widths 1, 2 and 3 run over the words of a whole text; each
filter's maximum over the text goes to a logistic layer. All labelled texts are
read, whole: those with three in four ids fit the model, the others set the
decision threshold of each language. The language is guessed from the text's
own function words. A score is the logistic value moved so that its language's
threshold lies at 0.5.

Fitting goes by rounds (iterative parameter mixing): the texts lie in shards of
about ``SHARD_TEXTS``; in each round every shard takes its steps from the common
model, and the changes of all shards are averaged, a bucket's over the shards
that changed it. Shards grow in number with the corpus; what comes to the driver
after a round is one model. Thresholds are found by Spark from the values of all
texts set apart.

Scoring is one pass over the rows: the model (8 MB of embeddings whatever the
corpus) is broadcast, no rows are shuffled.
"""

from __future__ import annotations

import copy
import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm import kernels as kn
from quarry.session import scratch_path

#: Hash buckets, embedding size, filters of each width.
BUCKETS, SIZE, FILTERS, WIDTHS = 1 << 18, 8, 8, (1, 2, 3)
#: Rounds of training, step size, labelled texts of a shard; one id in so many calibrates.
EPOCHS, RATE, SHARD_TEXTS, APART = 8, 0.2, 4000, 4
#: Share of a text's words that a step leaves out.
DROPPED = 0.4
#: A bucket is trained if so many texts hold it.
LEAST_TEXTS = 4
#: A language has its own threshold if so many texts of either label calibrate it.
LEAST_OF_LANGUAGE = 10
#: Buckets whose changes travel together; texts that go to Python at a time.
CHUNK, BATCH_ROWS = 1 << 12, 500
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Label tables up to this size are broadcast to the texts, larger ones are joined by shuffle.
BROADCAST_BYTES = 16 << 20
#: Parts of the unit by which values are dealt out to find a threshold.
BINS = 16
_TEXTS = "doc_id long, label int, words binary, heads binary, language long, shard int, place long"
_CHANGES = "part int, shard int, ids binary, changes binary"
PREFIX = 4

#: Function words by which a language is told.
FUNCTION_WORDS = {
    "de": "auf das dem den der des die ein eine für im in ist mit nicht sich und von zu",
    "en": "and are as at by for from in is it not of on that the this to was with",
    "es": "al con de del el en es la las lo los no para por que se su un una y",
    "fr": "au dans de des du en est et il la le les ne par pas pour que qui sur une",
}
_MARKS = kn.byte_class(bytes(c for c in range(128) if not chr(c).isalnum()))


@dataclass
class Model:
    """Parameters; ``thresholds`` by language number, the last for unknown ones."""

    embeddings: np.ndarray
    filters: list[np.ndarray]
    biases: np.ndarray
    weights: np.ndarray
    bias: float
    thresholds: np.ndarray = field(default_factory=lambda: np.zeros(len(FUNCTION_WORDS) + 1))


def new_model(seed: int = 0) -> Model:
    rng = np.random.default_rng(seed)
    n = FILTERS * len(WIDTHS)
    return Model(np.zeros((BUCKETS, SIZE), np.float32), [rng.normal(0, 0.5, (w, SIZE, FILTERS)).astype(np.float32) for w in WIDTHS],
                 np.zeros(n, np.float32), rng.normal(0, 0.5, n).astype(np.float32), 0.0)


def word_ids(column: pa.Array, powers: kn.Powers) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bucket of every word and of its prefix, the rows' word offsets, the rows' languages."""
    buf, off = kn.text_buffer(column)
    buf = kn.LOWER[buf]
    starts, ends, rows = kn.word_spans(buf, off, _MARKS)
    hashes = kn.word_hashes(buf, starts, ends, powers)
    heads = kn.mix(kn.word_hashes(buf, starts, np.minimum(ends, starts + PREFIX), powers))
    return (hashes % np.uint64(BUCKETS)).astype(np.int32), (heads % np.uint64(BUCKETS)).astype(np.int32), rows, _languages(hashes, rows, powers)


def _languages(hashes: np.ndarray, rows: np.ndarray, powers: kn.Powers) -> np.ndarray:
    """Language whose function words are most frequent; len(FUNCTION_WORDS) if none occurs."""
    n = len(rows) - 1
    votes = np.zeros((n, len(FUNCTION_WORDS)), dtype=np.int64)
    for i, name in enumerate(sorted(FUNCTION_WORDS)):
        buf, off = kn.text_buffer(pa.array([FUNCTION_WORDS[name]]))
        s, e, _ = kn.word_spans(buf, off, _MARKS)
        hit = np.flatnonzero(np.isin(hashes, kn.word_hashes(buf, s, e, powers)))
        votes[:, i] = np.bincount(np.searchsorted(rows, hit, side="right") - 1, minlength=n)[:n]
    return np.where(votes.max(axis=1, initial=0) > 0, votes.argmax(axis=1) if n else 0, len(FUNCTION_WORDS))


def _maps(model: Model, x: np.ndarray) -> np.ndarray:
    """Filter values at every place; ``x`` ends in max(WIDTHS) - 1 rows of zeros."""
    n = len(x) - max(WIDTHS) + 1
    out = np.empty((n, FILTERS * len(WIDTHS)), dtype=np.float32)
    for i, w in enumerate(model.filters):
        z = x[:n] @ w[0]
        for j in range(1, len(w)):
            z += x[j: j + n] @ w[j]
        out[:, FILTERS * i: FILTERS * (i + 1)] = z
    return out + model.biases


def logits(model: Model, words: np.ndarray, heads: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Value of the logistic layer for each row before the threshold."""
    n, pad = len(rows) - 1, max(WIDTHS) - 1
    lengths = np.diff(rows)
    place = np.arange(len(words)) + np.repeat(np.arange(n), lengths) * pad
    x = np.zeros((len(words) + n * pad, SIZE), dtype=np.float32)
    x[place] = model.embeddings[words] + model.embeddings[heads]
    pooled = np.zeros((n, FILTERS * len(WIDTHS)), dtype=np.float32)
    if len(words):
        z = np.concatenate([_maps(model, x), np.full((pad, FILTERS * len(WIDTHS)), -np.inf, np.float32)])
        first = rows[:-1] + np.arange(n) * pad
        # A row's places end before its zeros; those of width over 1 that reach into the zeros count.
        z[np.concatenate([first + lengths + j for j in range(pad)])] = -np.inf
        full = lengths > 0
        pooled[full] = np.maximum(0, np.maximum.reduceat(z, first, axis=0)[full])
    return pooled @ model.weights + model.bias


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


def _start(trained: np.ndarray, rng: np.random.Generator, seed: int = 0) -> tuple[Model, dict]:
    """Model and sums of squared steps before training; buckets not ``trained`` stay at zero."""
    model = new_model(seed)
    model.embeddings[trained] = rng.normal(0, 0.1, (int(trained.sum()), SIZE)).astype(np.float32)
    n = FILTERS * len(WIDTHS)
    return model, {"e": np.full((BUCKETS, 1), 1e-2, np.float32), "b": np.full(n, 1e-2), "w": np.full(n, 1e-2), "c": 1e-2,
                   "f": [np.full_like(f, 1e-2) for f in model.filters]}


def _balance(n: int, positive: int) -> tuple[float, float]:
    """Weights by which labels weigh alike in total."""
    return n / max(1, 2 * (n - positive)), n / max(1, 2 * positive)


def descend(model: Model, seen: dict, trained: np.ndarray, samples: Iterator[tuple[np.ndarray, np.ndarray, int]], balance: tuple[float, float],
            rng: np.random.Generator, rate: float = RATE) -> None:
    """A stochastic gradient step (Adagrad) on every text; ``model`` and ``seen``
    change. Each step leaves out another random part of the text's words, so
    that no filter rests on one of them; over the rounds all words are seen."""
    n = FILTERS * len(WIDTHS)
    pad = np.zeros((max(WIDTHS) - 1, SIZE), dtype=np.float32)
    for words, heads, y in samples:
        kept = rng.random(len(words)) >= DROPPED
        words, heads = words[kept], heads[kept]
        if len(words) == 0:
            continue
        x = np.concatenate([model.embeddings[words] + model.embeddings[heads], pad])
        z = _maps(model, x)
        best = z.argmax(axis=0)
        top = np.maximum(0, z[best, np.arange(n)])
        error = float((sigmoid(top @ model.weights + model.bias) - y) * balance[y])
        if abs(error) < 1e-3:
            continue
        back = np.where(top > 0, error * model.weights, 0).astype(np.float32)
        step_w = error * top + 1e-4 * model.weights
        seen["w"] += step_w ** 2
        seen["b"] += back ** 2
        seen["c"] += error ** 2
        places, grads = [], []
        for f in np.flatnonzero(back):
            i, column = divmod(int(f), FILTERS)
            kernel, sums = model.filters[i], seen["f"][i]
            for j in range(len(kernel)):
                p = best[f] + j
                if p < len(words):
                    places.append(p)
                    grads.append(back[f] * kernel[j, :, column])
                    g = back[f] * x[p]
                    sums[j, :, column] += g ** 2
                    kernel[j, :, column] -= rate * g / np.sqrt(sums[j, :, column])
        if places:
            grad = np.array(grads, dtype=np.float32)
            for ids in (words[places], heads[places]):
                own = trained[ids]
                np.add.at(seen["e"], ids[own], (grad[own] ** 2).mean(axis=1, keepdims=True))
                np.add.at(model.embeddings, ids[own], -rate * grad[own] / np.sqrt(seen["e"][ids[own]]))
        model.weights -= (rate * step_w / np.sqrt(seen["w"])).astype(np.float32)
        model.biases -= (rate * back / np.sqrt(seen["b"])).astype(np.float32)
        model.bias -= rate * error / float(np.sqrt(seen["c"]))


def train(samples: list[tuple[np.ndarray, np.ndarray, int]], epochs: int = EPOCHS, rate: float = RATE, seed: int = 0) -> Model:
    """Stochastic gradient steps (Adagrad) on (words, heads, label) of one text each.

    Only buckets that ``LEAST_TEXTS`` of the texts hold are trained; all
    others, and words never seen, stay at zero. Labels weigh alike in total.
    """
    rng = np.random.default_rng(seed)
    held = np.zeros(BUCKETS, dtype=np.int32)
    for words, heads, _ in samples:
        held[np.unique(np.concatenate([words, heads]))] += 1
    trained = held >= LEAST_TEXTS
    model, seen = _start(trained, rng, seed)
    balance = _balance(len(samples), sum(y for _, _, y in samples))
    for _ in range(epochs):
        descend(model, seen, trained, (samples[at] for at in rng.permutation(len(samples))), balance, rng, rate)
    return model


def best_threshold(values: np.ndarray, labels: np.ndarray) -> float:
    """Cut with the highest F1, in the middle of the gap it lies in."""
    order = np.argsort(-values, kind="stable")
    v, y = values[order], labels[order]
    hits = np.cumsum(y)
    f1 = 2 * hits / (np.arange(1, len(y) + 1) + y.sum())
    f1[:-1][v[:-1] == v[1:]] = -1  # no cut between equal values
    at = int(f1.argmax())
    return float((v[at] + v[at + 1]) / 2) if at + 1 < len(v) else float(v[at] - 1)


def calibrate(model: Model, values: np.ndarray, labels: np.ndarray, languages: np.ndarray, least: int = LEAST_OF_LANGUAGE) -> None:
    """Thresholds by language; a language with under ``least`` texts of either
    label takes the threshold of all texts."""
    if labels.min(initial=1) == labels.max(initial=0):
        return
    model.thresholds[:] = best_threshold(values, labels)
    for i in range(len(FUNCTION_WORDS)):
        own = languages == i
        if min(labels[own].sum(), (1 - labels[own]).sum()) >= least:
            model.thresholds[i] = best_threshold(values[own], labels[own])


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    powers = kn.Powers()
    for batch in batches:
        for part in kn.slices(batch, "text"):
            words, heads, rows, language = word_ids(part.column("text"), powers)
            yield pa.RecordBatch.from_pydict({
                "doc_id": part.column("doc_id"), "label": part.column("label"),
                "words": pa.array([words[a:b].tobytes() for a, b in zip(rows[:-1], rows[1:])], pa.binary()),
                "heads": pa.array([heads[a:b].tobytes() for a, b in zip(rows[:-1], rows[1:])], pa.binary()), "language": pa.array(language, pa.int64())})


def _once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order, without copies of the row before (an id and its words)."""
    last = None
    for batch in batches:
        keep = []
        for doc, words in zip(batch.column("doc_id").to_pylist(), batch.column("words").to_pylist()):
            keep.append((doc, words) != last)
            last = (doc, words)
        yield batch.filter(pa.array(keep, pa.bool_()))


def _samples(batch: pa.RecordBatch, order: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    words, heads, label = (batch.column(c) for c in ("words", "heads", "label"))
    for r in order.tolist():
        yield np.frombuffer(words[r].as_buffer(), np.int32), np.frombuffer(heads[r].as_buffer(), np.int32), label[r].as_py()


def _texts_by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = np.zeros(BUCKETS, dtype=np.int64)
    for batch in batches:
        for words, heads, _ in _samples(batch, np.arange(batch.num_rows)):
            held[np.unique(np.concatenate([words, heads]))] += 1
    bucket = np.flatnonzero(held)
    yield pa.RecordBatch.from_pydict({"bucket": pa.array(bucket), "n": pa.array(held[bucket])})


def _dense(model: Model, seen: dict) -> np.ndarray:
    """All parameters besides the embeddings, and their sums of squared steps, in one row."""
    return np.concatenate([x.ravel() for x in (*model.filters, model.biases, model.weights, np.array([model.bias]), *seen["f"], seen["b"], seen["w"],
                                               np.array([seen["c"]]))]).astype(np.float64)


def _moved(model: Model, seen: dict, dense: np.ndarray) -> None:
    """Adds a row like that of ``_dense``."""
    at = 0
    for x in (*model.filters, model.biases, model.weights, None, *seen["f"], seen["b"], seen["w"]):
        n = 1 if x is None else x.size
        if x is None:
            model.bias += float(dense[at])
        else:
            x += dense[at: at + n].reshape(x.shape).astype(x.dtype)
        at += n
    seen["c"] += float(dense[at])


def _round(shared, epoch: int, balance: tuple[float, float]):
    """The steps of every shard from the common model, as changes by part of the buckets (the last part: all else)."""

    def changes(shard: int, model: Model, seen: dict, old: Model, before: dict) -> Iterator[pa.RecordBatch]:
        moved = np.concatenate([model.embeddings - old.embeddings, seen["e"] - before["e"]], axis=1)
        ids = np.flatnonzero(moved.any(axis=1))
        cuts = np.searchsorted(ids, np.arange(0, BUCKETS + 1, CHUNK))
        rows = [(p, ids[a:b].astype(np.int32).tobytes(), moved[ids[a:b]].tobytes()) for p, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])) if b > a]
        rows.append((BUCKETS // CHUNK, b"", (_dense(model, seen) - _dense(old, before)).tobytes()))
        part, ids, values = zip(*rows)
        yield pa.RecordBatch.from_pydict({"part": pa.array(part, pa.int32()), "shard": pa.array([shard] * len(rows), pa.int32()),
                                          "ids": pa.array(ids, pa.binary()), "changes": pa.array(values, pa.binary())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values, before, trained = shared.value
        old, shard, model, seen = Model(**values), None, None, None
        for batch in batches:
            own = batch.column("shard").to_numpy()
            for at in np.unique(own).tolist():
                if at != shard:
                    if shard is not None:
                        yield from changes(shard, model, seen, old, before)
                    shard, model, seen = at, copy.deepcopy(old), copy.deepcopy(before)
                    rng = np.random.default_rng([epoch, shard])
                descend(model, seen, trained, _samples(batch, rng.permutation(np.flatnonzero(own == at))), balance, rng)
        if shard is not None:
            yield from changes(shard, model, seen, old, before)

    return run


def _mean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Mean changes of each part, whose rows come together."""
    part, total, n = None, None, None

    def result() -> pa.RecordBatch:
        ids = np.flatnonzero(n)
        return pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "shard": pa.array([0], pa.int32()), "ids": pa.array([ids.astype(np.int32).tobytes()], pa.binary()),
                                           "changes": pa.array([(total[ids] / n[ids, None]).tobytes()], pa.binary())})

    for batch in batches:
        for r in batch.to_pylist():
            dense = r["part"] == BUCKETS // CHUNK
            values = np.frombuffer(r["changes"], np.float64 if dense else np.float32).reshape(*((1, -1) if dense else (-1, SIZE + 1)))
            ids = np.zeros(1, np.int64) if dense else np.frombuffer(r["ids"], np.int32) - r["part"] * CHUNK
            if r["part"] != part:
                if part is not None:
                    yield result()
                part, n, total = r["part"], np.zeros(1 if dense else CHUNK, np.int64), np.zeros((1 if dense else CHUNK, values.shape[1]))
            total[ids] += values
            n[ids] += 1
    if part is not None:
        yield result()


def _values(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(**shared.value)
        for batch in batches:
            value = [float(logits(model, w, h, np.array([0, len(w)]))[0]) for w, h, _ in _samples(batch, np.arange(batch.num_rows))]
            yield pa.RecordBatch.from_pydict({"language": batch.column("language"), "label": batch.column("label"), "value": pa.array(value, pa.float64())})

    return run


def thresholds(values: DataFrame) -> dict[int, tuple[int, int, float]]:
    """Texts of label 1 and 0, and the cut with the highest F1 (as ``best_threshold``
    finds it), by language; of all texts under -1. Equal values count once, and
    values are dealt out in bins of a 16th, so that no language meets in one task."""
    both = values.unionByName(values.withColumn("language", F.lit(-1).cast("bigint")))
    points = both.groupBy("language", "value").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("hits")).withColumn("bin", F.floor(F.col("value") * BINS))
    own, higher = Window.partitionBy("language"), Window.partitionBy("language").orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, -1)
    bins = points.groupBy("language", "bin").agg(F.sum("n").alias("n"), F.sum("hits").alias("hits")).select(
        "language", "bin", F.sum("n").over(own).alias("texts"), F.sum("hits").over(own).alias("positive"),
        F.coalesce(F.sum("n").over(higher), F.lit(0)).alias("n_above"), F.coalesce(F.sum("hits").over(higher), F.lit(0)).alias("hits_above"))
    down = Window.partitionBy("language", "bin").orderBy(F.desc("value")).rowsBetween(Window.unboundedPreceding, 0)
    ranked = points.join(bins, ["language", "bin"]).select(
        "language", "value", "texts", "positive", (F.sum("n").over(down) + F.col("n_above")).alias("n"), (F.sum("hits").over(down) + F.col("hits_above")).alias("hits"))
    best = ranked.groupBy("language", "texts", "positive").agg(
        F.max(F.struct((2 * F.col("hits") / (F.col("n") + F.col("positive"))).alias("f1"), F.col("value").alias("value"))).alias("top")).select(
        "language", "texts", "positive", F.col("top.value").alias("cut"))
    below = points.join(F.broadcast(best), "language").where(F.col("value") < F.col("cut")).groupBy("language").agg(F.max("value").alias("below"))
    rows = best.join(below, "language", "left").collect()  # a row a language
    return {r["language"]: (r["positive"], r["texts"] - r["positive"], r["cut"] - 1 if r["below"] is None else (r["cut"] + r["below"]) / 2) for r in rows}


def _few_at_a_time(spark, action):
    """``action`` run with few rows going to Python at a time: rows are whole texts."""
    before = spark.conf.get(ARROW_ROWS)
    spark.conf.set(ARROW_ROWS, str(min(int(before), BATCH_ROWS) if int(before) > 0 else BATCH_ROWS))
    try:
        return action()
    finally:
        spark.conf.set(ARROW_ROWS, before)


def _labelled(docs: DataFrame, labels: DataFrame, label_col: str) -> DataFrame:
    """Words of every labelled text, in a written table, a shard after another."""
    spark = docs.sparkSession
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label_col).isNotNull()).groupBy("doc_id").agg(F.max(F.col(label_col).cast("int")).alias("label"))
    n = known.count()
    shards = max(1, math.ceil(n / SHARD_TEXTS))
    own = docs.select("doc_id", "text").join(F.broadcast(known) if n * 64 <= BROADCAST_BYTES else known.hint("merge"), "doc_id")
    words = own.select("doc_id", "text", "label").mapInArrow(_tokens, "doc_id long, label int, words binary, heads binary, language long")
    shard = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(shards)).cast("int")
    rows = words.withColumn("shard", shard).withColumn("place", F.xxhash64("doc_id", F.lit(2))).repartitionById(shards, "shard").sortWithinPartitions("place", "doc_id", "words")
    path = scratch_path(spark, "toxicity-words")
    _few_at_a_time(spark, lambda: rows.mapInArrow(_once, _TEXTS).write.parquet(path))
    return spark.read.schema(_TEXTS).parquet(path)


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "toxic") -> Model:
    """Model trained on all labelled documents, whole texts: ids with a hash
    divisible by ``APART`` calibrate, the others are fitted.

    Null ids and labels are left out; of an id labelled twice the higher label
    counts, and equal texts of one id count once. Without both labels the model
    is untrained and scores every text alike. The result depends on the rows
    alone, not on their order or on the number of executors.
    """
    spark = docs.sparkSession
    stored = _labelled(docs, labels, label_col)
    apart = F.pmod(F.xxhash64("doc_id"), F.lit(APART)) == 0
    fitting = stored.where(~apart)
    n, positive = fitting.agg(F.count(F.lit(1)), F.sum("label")).first()
    if not n or positive in (0, n):
        return new_model()
    held = fitting.mapInArrow(_texts_by_bucket, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_TEXTS)
    trained = np.zeros(BUCKETS, dtype=bool)
    trained[_few_at_a_time(spark, lambda: held.select("bucket").toArrow()).column(0).to_numpy()] = True
    model, seen = _start(trained, np.random.default_rng(0))
    for epoch in range(EPOCHS):
        shared = spark.sparkContext.broadcast((vars(model), seen, trained))
        moved = fitting.mapInArrow(_round(shared, epoch, _balance(n, positive)), _CHANGES)
        mean = moved.repartition("part").sortWithinPartitions("part", "shard").mapInArrow(_mean, _CHANGES)
        for r in _few_at_a_time(spark, mean.collect):  # one model
            if r["part"] == BUCKETS // CHUNK:
                _moved(model, seen, np.frombuffer(r["changes"], np.float64))
            else:
                ids = np.frombuffer(r["ids"], np.int32) + r["part"] * CHUNK
                values = np.frombuffer(r["changes"], np.float64).reshape(-1, SIZE + 1).astype(np.float32)
                model.embeddings[ids] += values[:, :SIZE]
                seen["e"][ids] += values[:, SIZE:]
        shared.unpersist()
    path = scratch_path(spark, "toxicity-values")
    shared = spark.sparkContext.broadcast(vars(model))
    _few_at_a_time(spark, lambda: stored.where(apart).mapInArrow(_values(shared), "language long, label int, value double").write.parquet(path))
    found = thresholds(spark.read.schema("language long, label int, value double").parquet(path))
    if -1 in found and found[-1][0] and found[-1][1]:
        model.thresholds[:] = found[-1][2]
        for language, (ones, zeros, cut) in found.items():
            if 0 <= language < len(FUNCTION_WORDS) and min(ones, zeros) >= LEAST_OF_LANGUAGE:
                model.thresholds[language] = cut
    return model


def _score(shared, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, model = kn.Powers(), Model(**shared.value)
        names = np.array([*sorted(FUNCTION_WORDS), "other"], dtype=object)
        for batch in batches:
            for part in kn.slices(batch, "text"):
                words, heads, rows, language = word_ids(part.column("text"), powers)
                score = sigmoid(logits(model, words, heads, rows).astype(np.float64) - model.thresholds[language])
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(np.diff(rows)), pa.array(names[language], pa.string()), pa.array(score)],
                                                 schema=schema)

    return run


def score_toxicity(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, guessed_lang, score (0 to 1; toxic from 0.5 on), one row
    per input row. Null and empty texts get the score of no words. Only the
    text is read; the id passes through."""
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = T.StructType([T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("n_words", T.LongType()),
                           T.StructField("guessed_lang", T.StringType()), T.StructField("score", T.DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return source.mapInArrow(_score(shared, to_arrow_schema(schema)), schema)


kn.ship(__name__)
