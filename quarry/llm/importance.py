"""Quality by importance resampling.

Target text (documents labelled good) and raw text (all documents) are each
modelled as a bag of hashed words and word pairs. A document's weight is the
log ratio of its probability under the two models; adding Gumbel noise and
taking the greatest k samples k documents without replacement in proportion to
their weights.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm import kernels as kn
from quarry.session import scratch_path

#: Hash buckets of a model.
BUCKETS = 1 << 16
#: Cells of the table of good ids that spares other texts the join (a few bytes each, whatever the number of ids).
CELLS = 1 << 20
_COUNTS = "part int, counts binary"


def features(part: pa.RecordBatch, powers: kn.Powers, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket of every word and of every pair of neighbours, with its row; and words per row."""
    buf, off = kn.text_buffer(part.column("text"))
    starts, ends, rows = kn.word_spans(kn.LOWER[buf], off, kn.SPACE)
    words = kn.word_hashes(kn.LOWER[buf], starts, ends, powers)
    row = np.repeat(np.arange(len(rows) - 1), np.diff(rows))
    pair = np.flatnonzero(row[1:] == row[:-1])
    pairs = kn.mix(words[pair] * np.uint64(kn.BASE_B) + words[pair + 1])
    return (np.concatenate([words, pairs]) % np.uint64(buckets)).astype(np.int64), np.concatenate([row, row[pair]]), np.diff(rows)


def _count(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = kn.Powers()
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for part in kn.slices(batch, "text"):
                total += np.bincount(features(part, powers, buckets)[0], minlength=buckets)
        step = max(1, buckets // 16)  # in sixteen parts, to be added up side by side
        yield pa.RecordBatch.from_pydict({"part": pa.array(range(0, buckets, step), pa.int32()),
                                          "counts": [total[i: i + step].tobytes() for i in range(0, buckets, step)]})

    return run


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for r in batch.to_pylist():
            own = np.frombuffer(r["counts"], dtype=np.int64)
            sums[r["part"]] = sums[r["part"]] + own if r["part"] in sums else own
    yield pa.RecordBatch.from_pydict({"part": pa.array(list(sums), pa.int32()), "counts": pa.array([x.tobytes() for x in sums.values()], pa.binary())})


def bucket_counts(docs: DataFrame, buckets: int) -> np.ndarray:
    """Occurrences of every bucket in the column text."""
    n = max(8, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    counts = docs.select("text").mapInArrow(_count(buckets), _COUNTS).repartition(n, "part").mapInArrow(_add, _COUNTS)
    total = np.zeros(buckets, dtype=np.int64)
    for r in counts.collect():  # 8 bytes a bucket in all
        own = np.frombuffer(bytes(r["counts"]), dtype=np.int64)
        total[r["part"]: r["part"] + len(own)] += own
    return total


def good_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of ``docs`` that are labelled good. Only texts whose id falls into
    a cell of the good ids are shuffled for the join (all, once the good ids
    fill the ``CELLS`` cells); a null id is in none."""
    good = labels.where((F.col("quality") == 1) & F.col("doc_id").isNotNull()).select(F.col("doc_id").alias("_good")).distinct()
    cell = lambda c: F.pmod(F.xxhash64(F.col(c).cast("string")), F.lit(CELLS))
    cells = good.select(cell("_good").alias("_cell")).distinct()
    near = docs.join(F.broadcast(cells), cell("doc_id") == F.col("_cell"), "left_semi")
    return near.join(good.hint("merge"), F.col("doc_id") == F.col("_good"), "left_semi")


def log_ratios(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Log probability ratio of every bucket (smoothed by one): target over raw.

    Raw counts cover all documents, target counts all that are labelled good.
    """
    raw = bucket_counts(docs, buckets) + 1.0
    target = bucket_counts(good_documents(docs, labels), buckets) + 1.0
    return np.log(target / target.sum()) - np.log(raw / raw.sum())


def _score(ratios: np.ndarray, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = kn.Powers()
        for batch in batches:
            for part in kn.slices(batch, "text"):
                bucket, row, words = features(part, powers, len(ratios))
                weight = np.bincount(row, weights=ratios[bucket], minlength=part.num_rows)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(words.astype(np.int64)), pa.array(weight),
                                                  part.column("_noise")], schema=schema)

    return run


def importance_scores(docs: DataFrame, ratios: np.ndarray, id_col: str = "doc_id", text_col: str = "text", seed: int = 0) -> DataFrame:
    """doc_id, n_words, log_weight, noisy_weight (with Gumbel noise drawn by a
    hash of id and text: the same in every run). Null and empty texts weigh 0."""
    from pyspark.sql.pandas.types import to_arrow_schema

    hashed = F.xxhash64(F.col(id_col), F.col(text_col), F.lit(seed))
    uniform = (F.shiftrightunsigned(hashed, 11).cast("double") + 0.5) / F.lit(float(1 << 53))
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), (-F.log(-F.log(uniform))).alias("_noise"))
    schema = T.StructType([T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("n_words", T.LongType()),
                           T.StructField("log_weight", T.DoubleType()), T.StructField("_noise", T.DoubleType())])
    scored = source.mapInArrow(_score(ratios, to_arrow_schema(schema)), schema)
    return scored.select("doc_id", "n_words", "log_weight", (F.col("log_weight") + F.col("_noise")).alias("noisy_weight"))


def threshold_of_rank(values: DataFrame, column: str, k: int, cells: int = 1024) -> float:
    """The k-th greatest value, by counting values in ever finer cells: each
    pass sends ``cells`` counts to the driver, whatever the table's size."""
    lo, hi, n = values.agg(F.min(column), F.max(column), F.count(column)).first()
    if k >= n or lo == hi:
        return lo
    above = 0  # values over the current range
    while True:
        width = (hi - lo) / cells
        inside = values.where((F.col(column) >= lo) & (F.col(column) <= hi))
        if width <= 0 or lo + width == lo:
            return lo
        cell = F.least(F.floor((F.col(column) - lo) / width), F.lit(cells - 1))
        found = inside.groupBy(cell.alias("c")).agg(F.count("*").alias("n"), F.min(column).alias("lo"), F.max(column).alias("hi")).collect()
        for r in sorted(found, key=lambda r: -r["c"]):
            if above + r["n"] >= k:
                if r["lo"] == r["hi"]:
                    return r["lo"]
                if r["n"] <= 10_000:  # few left: exact
                    rest = sorted((x[0] for x in inside.where((F.col(column) >= r["lo"]) & (F.col(column) <= r["hi"])).select(column).collect()), reverse=True)
                    return rest[k - above - 1]
                lo, hi = r["lo"], r["hi"]
                break
            above += r["n"]


def resample(docs: DataFrame, labels: DataFrame, share: float | None = None, id_col: str = "doc_id", text_col: str = "text",
             seed: int = 0) -> DataFrame:
    """Columns of ``importance_scores`` and selected, one row per input row.

    ``share`` of the rows is selected, by default the share of good ones among
    the labelled. Rows with equal noisy weights at the border (exact repeats of
    a row) are selected together. Without labels the weights are noise around
    zero and everything is selected; an empty table gives none.
    """
    spark = docs.sparkSession
    if share is None:
        share = labels.agg(F.avg(F.col("quality").cast("double"))).first()[0]
        share = 1.0 if share is None else share
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    scores = importance_scores(own, log_ratios(own, labels), seed=seed)
    path = scratch_path(spark, "importance")
    scores.write.parquet(path)
    scores = spark.read.schema(scores.schema).parquet(path)
    n = scores.count()
    k = round(share * n)
    if k < 1:
        return scores.withColumn("selected", F.lit(False))
    return scores.withColumn("selected", F.col("noisy_weight") >= F.lit(threshold_of_rank(scores, "noisy_weight", k)))


kn.ship(__name__)
