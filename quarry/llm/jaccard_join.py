"""Similarity classes by T-occurrence search over shingle lists (DivideSkip).

Two texts are linked when 100 * |A and B| >= percent * |A or B| for their sets of
word shingles. A partner of a text x lacks at most e = |x| - T of its shingles,
where T = ceil(percent |x| / 100) is the least overlap. So of the lists (which texts hold
a shingle) of x, the T - 1 longest can be skipped and only the e + 1 shortest
are merged: any partner is in one of those. Texts found there are retained if
they still can reach the overlap, and decided by binary search in the sorted
sets, which stands for probing the long lists.

Only one row per class of equal sets takes part (exact copies join afterwards),
and the search asks only for links between different classes:

1. Texts that share one of their least shingle hashes are compared with the
   first of them; true links merge classes early. This only saves work.
2. A fixed part of the shingle space is dealt out. A shingle whose texts all
   are in one class is settled there. A text with more than e such shingles
   has no partner outside its class and is done; these are nearly all.
3. The texts left deal out all shingles, learn the lengths of their lists, and
   merge the e + 1 shortest; candidates are verified exactly.

Components of the verified links give the classes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm import kernels as kn
from quarry.llm import repeats
from quarry.llm.components import component_minimum
from quarry.session import scratch_path

#: Percent and words of a shingle where none are asked for.
PERCENT, SHINGLE = 85, 4
#: A shingle set held by one text in so many is joined by broadcast: there are no more such sets than this.
HOT_SHARE = 1000
#: Least hashes kept of a text, and how many of them look for an early partner.
LEAST, KEYS = 16, 4
#: Part of the shingle space dealt out first; texts up to ALL shingles deal out all.
PART, ALL = 0.3, 100
#: Shingles and bytes of text that a task works on at a time.
FLUSH, SLICE = 500_000, 1 << 19
ARROW_ROWS, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 1000
#: Small tables up to this size are broadcast to the texts, larger ones are joined by shuffle.
BROADCAST_BYTES = 16 << 20
_LIMIT = np.uint64(int(PART * (1 << 48)))
_SETS = "doc_id long, tag long, n_shingles long, one long, two long, least array<long>"
_TABLE = {"doc": "<i8", "tag": "<u4", "size": "<u4", "known": "<u4", "class": "<i8"}
_DEALT = "bucket int, token binary, node binary, " + ", ".join(f"{c} binary" for c in _TABLE)


def required(size: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Least overlap of a text of so many shingles with any partner."""
    return -(-percent * size // 100)


def required_pair(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    return -(-percent * (a + b) // (100 + percent))


def shingle_sets(column: pa.Array, powers: kn.Powers, shingle: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every row; a text of fewer words is one shingle."""
    buf, off = kn.text_buffer(column)
    buf = kn.LOWER[buf]
    starts, ends, rows = kn.word_spans(buf, off, kn.SPACE)
    words = kn.word_hashes(buf, starts, ends, powers)
    out = []
    at = 0
    while at < len(rows) - 1:
        to = max(at + 1, int(np.searchsorted(rows, rows[at] + kn.SLICE_BYTES, side="right")) - 1)
        lo, hi = rows[at], rows[to]
        if hi - lo <= kn.SLICE_BYTES:
            prefix = powers.prefix(words[lo:hi])
            grams = kn.mix(powers.grams(prefix, shingle))
            for r in range(at, to):
                a, b = int(rows[r] - lo), int(rows[r + 1] - lo)
                if b - a >= shingle:
                    out.append(np.unique(grams[a: b - shingle + 1]))
                elif b > a:
                    out.append(kn.mix(powers.span(prefix, np.array([a]), np.array([b])) + np.uint64(b - a)))
                else:
                    out.append(grams[:0])
        else:  # one text of very many words, in overlapping pieces
            pieces = [words[i: min(hi, i + kn.SLICE_BYTES)] for i in range(lo, hi - shingle + 1, kn.SLICE_BYTES - shingle + 1)]
            out.append(np.unique(np.concatenate([kn.mix(powers.grams(powers.prefix(p), shingle)) for p in pieces])))
        at = to
    return out


def _describe(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = kn.Powers()
        for batch in batches:
            for part in kn.slices(batch, "text", SLICE):
                sets = shingle_sets(part.column("text"), powers, shingle)
                digests = np.frombuffer(b"".join(hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets), dtype="<i8").reshape(-1, 2)
                yield pa.RecordBatch.from_pydict({
                    "doc_id": part.column("doc_id"), "tag": part.column("tag"), "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
                    "one": digests[:, 0].copy(), "two": digests[:, 1].copy(), "least": pa.array([s[:LEAST].view(np.int64) for s in sets], pa.list_(pa.int64()))})

    return run


def _written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written and read again; rows with texts or sets go to Python ``BATCH_ROWS`` at a time."""
    path = scratch_path(df.sparkSession, f"jaccard-{name}")
    conf = df.sparkSession.conf
    before = conf.get(ARROW_ROWS)
    conf.set(ARROW_ROWS, str(min(int(before), BATCH_ROWS) if int(before) > 0 else BATCH_ROWS))
    try:
        df.write.parquet(path)
    finally:
        conf.set(ARROW_ROWS, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _beside(texts: DataFrame, rows: DataFrame, keys: list[str], how: str = "inner", n: int | None = None) -> DataFrame:
    """``texts`` joined with a table of ``n`` entries of few bytes, which is
    broadcast only if all of it stays under a fixed size."""
    n = rows.count() if n is None else n
    return texts.join(F.broadcast(rows) if n * 64 <= BROADCAST_BYTES else rows.hint("merge"), keys, how)


# ------------------------------------------------------------------ verifying

def _sets_for(many: bool, shingle: int):
    """Sets of the rows, once for each of its pairs (``many``) or once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = kn.Powers()
        for batch in batches:
            for part in kn.slices(batch, "text", SLICE):
                sets = [s.tobytes() for s in shingle_sets(part.column("text"), powers, shingle)]
                doc, tag = part.column("doc_id").to_pylist(), part.column("tag").to_pylist()
                if not many:
                    yield pa.RecordBatch.from_pydict({"y_doc": pa.array(doc, pa.int64()), "y_tag": pa.array(tag, pa.int64()), "y_set": pa.array(sets, pa.binary())})
                    continue
                held: list[tuple] = []
                size = 0
                for r, ys in enumerate(part.column("ys").to_pylist()):
                    for y in ys:
                        held.append((y["y_doc"], y["y_tag"], doc[r], sets[r]))
                        size += len(sets[r])
                        if size > 16 * SLICE:
                            yield _pairs_batch(held)
                            held, size = [], 0
                if held:
                    yield _pairs_batch(held)

    return run


def _pairs_batch(rows: list[tuple]) -> pa.RecordBatch:
    y_doc, y_tag, x_doc, sets = zip(*rows)
    return pa.RecordBatch.from_pydict({"y_doc": pa.array(y_doc, pa.int64()), "y_tag": pa.array(y_tag, pa.int64()),
                                       "x_doc": pa.array(x_doc, pa.int64()), "x_set": pa.array(sets, pa.binary())})


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Common entries of two sorted sets, by binary search of the shorter in the longer."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == 0:
        return 0
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    return int((b[at] == a).sum())


def _linked(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            xs, ys = batch.column("x_set"), batch.column("y_set")
            for r in range(batch.num_rows):
                a, b = (np.frombuffer(c[r].as_buffer(), dtype=np.uint64) for c in (xs, ys))
                both = overlap(a, b)
                keep.append(100 * both >= percent * (len(a) + len(b) - both))
            keep = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_pydict({"a": batch.column("x_doc").filter(keep), "b": batch.column("y_doc").filter(keep)})

    return run


def verified(texts: DataFrame, pairs: DataFrame, shingle: int, percent: int, name: str) -> DataFrame:
    """a, b: the ids of the pairs (x_doc, x_tag, y_doc, y_tag) that are linked."""
    pairs = _written(pairs.distinct(), f"{name}-pairs")
    by_x = pairs.groupBy(F.col("x_doc").alias("doc_id"), F.col("x_tag").alias("tag")).agg(F.collect_list(F.struct("y_doc", "y_tag")).alias("ys"))
    ys = pairs.select(F.col("y_doc").alias("doc_id"), F.col("y_tag").alias("tag")).distinct()
    left = _beside(texts, by_x, ["doc_id", "tag"], n=pairs.count()).select("doc_id", "tag", "text", "ys").mapInArrow(kn.tidy(_sets_for(True, shingle)), "y_doc long, y_tag long, x_doc long, x_set binary")
    right = _beside(texts, ys, ["doc_id", "tag"]).select("doc_id", "tag", "text").mapInArrow(kn.tidy(_sets_for(False, shingle)), "y_doc long, y_tag long, y_set binary")
    both = left.join(right.hint("merge"), ["y_doc", "y_tag"]).select("x_doc", "x_set", "y_doc", "y_set")
    return _written(both.mapInArrow(kn.tidy(_linked(percent)), "a long, b long").distinct(), f"{name}-links")


# ------------------------------------------------------------- dealing shingles

def _deal(everything: bool, shingle: int, percent: int, buckets: int):
    """Shingles of the rows by bucket, packed with a table of the rows that hold them."""

    def ship(rows: list[tuple], sets: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        token = np.concatenate(sets)
        node = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        bucket = (kn.mix(token) % np.uint64(buckets)).astype(np.int64)
        order = np.lexsort((token, bucket))
        token, node, cuts = token[order], node[order], np.searchsorted(bucket[order], np.arange(buckets + 1))
        table = {c: np.array([r[i] for r in rows]) for i, c in enumerate(_TABLE)}
        for b in np.flatnonzero(np.diff(cuts)):
            own, at = np.unique(node[cuts[b]: cuts[b + 1]], return_inverse=True)
            yield pa.RecordBatch.from_pydict(
                {"bucket": pa.array([b], pa.int32()), "token": pa.array([_planes48(token[cuts[b]: cuts[b + 1]])], pa.binary()),
                 "node": pa.array([repeats._planes(at, "<u4")], pa.binary())} | {c: pa.array([repeats._planes(table[c][own], d)], pa.binary()) for c, d in _TABLE.items()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = kn.Powers()
        rows: list[tuple] = []
        sets: list[np.ndarray] = []
        size = 0
        for batch in batches:
            for part in kn.slices(batch, "text", SLICE):
                found = shingle_sets(part.column("text"), powers, shingle)
                columns = [part.column(c).to_pylist() for c in ("doc_id", "tag", "class")]
                for s, doc, tag, cls in zip(found, *columns):
                    n = len(s)
                    s = s >> np.uint64(16)
                    sampled = s[: np.searchsorted(s, _LIMIT)]
                    known = n if everything or n <= percent * ALL // 100 else len(sampled)
                    s = s if everything or n <= ALL else sampled if known else s[:1]  # at least one, to be heard of
                    if len(s):
                        rows.append((doc, tag, n, known, cls))
                        sets.append(s)
                        size += len(s)
                if size >= FLUSH:
                    yield from ship(rows, sets)
                    rows, sets, size = [], [], 0
        if rows:
            yield from ship(rows, sets)

    return run


def _planes48(token: np.ndarray) -> bytes:
    return np.ascontiguousarray(token.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :6].T.tobytes()


def _unplanes48(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(raw, dtype=np.uint8).reshape(6, -1)
    out = np.zeros((planes.shape[1], 8), dtype=np.uint8)
    out[:, :6] = planes.T
    return out.view("<u8").ravel()


def _lists(batches: Iterator[pa.RecordBatch]):
    """All entries of a task sorted by shingle, the rows' table, and for every
    entry the length of its list and whether it spans classes."""
    token, node, tables = [], [], {c: [] for c in _TABLE}
    base = 0
    for batch in batches:
        for r in batch.to_pylist():
            t = _unplanes48(r["token"])
            token.append(t)
            node.append(repeats._unplanes(r["node"], "<u4").astype(np.int64) + base)
            for c, d in _TABLE.items():
                tables[c].append(repeats._unplanes(r[c], d))
            base += len(tables["doc"][-1])
    if not token:
        return None
    token, node, table = np.concatenate(token), np.concatenate(node), {c: np.concatenate(v) for c, v in tables.items()}
    order = np.argsort(token, kind="stable")
    token, node = token[order], node[order]
    new = np.ones(len(token), dtype=bool)
    new[1:] = token[1:] != token[:-1]
    at, group = np.flatnonzero(new), np.cumsum(new) - 1
    cls = table["class"][node]
    spans = (np.minimum.reduceat(cls, at) != np.maximum.reduceat(cls, at))[group]
    length = np.diff(np.append(at, len(token)))[group]
    return token, node, table, length, spans


_COUNTS = _TABLE | {"n": "<u4"}
_LENGTHS = {"doc": "<i8", "tag": "<u4", "size": "<u4", "class": "<i8", "token": "<u8", "length": "<u4"}


def _packed(kinds: dict[str, str]) -> str:
    return "bucket int, " + ", ".join(f"{c} binary" for c in kinds)


def _shared_counts(percent: int, buckets: int):
    """Per row: how many of its counted shingles are shared with other classes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if (found := _lists(batches)) is None:
            return
        token, node, table, _, spans = found
        counted = spans & ((token < _LIMIT) | (table["size"][node] <= percent * ALL // 100))
        n = np.bincount(node[counted], minlength=len(table["doc"]))
        # Rows without any are silent, but those of which too few shingles are known must go on.
        few = table["known"].astype(np.int64) <= table["size"] - required(table["size"].astype(np.int64), percent)
        own = np.flatnonzero((n > 0) | few)
        yield from repeats.pack({c: v[own] for c, v in table.items()} | {"n": n[own]}, _COUNTS, buckets)

    return run


def _left_over(percent: int):
    """Rows that may have a partner: too few of their shingles stay within the class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if (x := repeats.unpack(batches, _COUNTS)) is None:
            return
        x, at, _ = repeats.grouped(x)
        alone = x["known"][at] - np.add.reduceat(x["n"], at)
        at = at[alone <= x["size"][at] - required(x["size"][at], percent)]
        yield pa.RecordBatch.from_pydict({"doc_id": x["doc"][at], "tag": x["tag"][at], "class": x["class"][at]})

    return run


def _list_lengths(buckets: int):
    """Per row: its shingles that are shared with other classes, and the lengths of their lists."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if (found := _lists(batches)) is None:
            return
        token, node, table, length, spans = found
        own = np.flatnonzero(spans)
        yield from repeats.pack({c: table[c][node[own]] for c in ("doc", "tag", "size", "class")} | {"token": token[own], "length": length[own]}, _LENGTHS, buckets)

    return run


def _shortest(percent: int):
    """The shortest lists of each row, with the shingle's place in the order by length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if (x := repeats.unpack(batches, _LENGTHS)) is None:
            return
        x, at, row = repeats.grouped(x, "length", "token")
        alone = x["size"] - np.diff(np.append(at, len(row)))[row]  # lists without another class come first
        place = np.arange(len(row)) - at[row] + alone
        keep = place <= x["size"] - required(x["size"], percent)
        yield pa.RecordBatch.from_pydict({"token": x["token"][keep].astype(np.int64), "place": place[keep]} | {c: x[c][keep] for c in ("doc", "tag", "class", "size")})

    return run


def _merge(percent: int):
    """Pairs of rows of different classes that share a merged list and can
    still reach the overlap required of their sizes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [b for b in batches if b.num_rows]
        if not parts:
            return
        x = {c: np.concatenate([b.column(c).to_numpy(zero_copy_only=False) for b in parts]) for c in parts[0].schema.names}
        order = np.lexsort((x["size"], x["token"]))
        x = {c: v[order] for c, v in x.items()}
        cut = np.flatnonzero(np.diff(x["token"], prepend=x["token"][0] - 1))
        seen: set[tuple] = set()
        for a, b in zip(cut, np.append(cut[1:], len(order))):
            if b - a < 2 or (x["class"][a:b] == x["class"][a]).all():
                continue
            size, rest, cls = x["size"][a:b], x["size"][a:b] - x["place"][a:b], x["class"][a:b]
            names, counts = np.unique(cls, return_counts=True)
            for i in np.flatnonzero(cls != names[counts.argmax()]):  # every pair sought has one outside the largest class
                lo, hi = np.searchsorted(size, required(size[i], percent)), np.searchsorted(size, size[i] * 100 // percent, side="right")
                reach = np.minimum(rest[lo:hi], rest[i]) >= required_pair(size[lo:hi], size[i], percent)
                for j in lo + np.flatnonzero(reach & (cls[lo:hi] != cls[i])):
                    one, two = ((int(x["doc"][a + k]), int(x["tag"][a + k])) for k in (i, j))
                    seen.add((max(one, two), min(one, two)))
            if len(seen) > 200_000:
                yield _as_pairs(seen)
                seen = set()
        if seen:
            yield _as_pairs(seen)

    return run


def _as_pairs(seen: set[tuple]) -> pa.RecordBatch:
    rows = [(*x, *y) for x, y in sorted(seen)]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=["x_doc", "x_tag", "y_doc", "y_tag"])


# --------------------------------------------------------------------- operator

def _early_pairs(sets: DataFrame) -> DataFrame:
    """Each text with the first of those that share one of its least hashes,
    if their least hashes agree enough to make a link likely."""
    node = F.struct(F.col("doc_id").alias("y_doc"), F.col("tag").alias("y_tag"), F.col("n_shingles").alias("y_n"), F.col("least").alias("y_least"))
    keyed = sets.select("doc_id", "tag", "n_shingles", "percent", "least", F.explode(F.slice("least", 1, KEYS)).alias("key"))
    first = keyed.groupBy("key").agg(F.min(node).alias("first"), F.count("*").alias("n")).where("n > 1").select("key", "first.*")
    near = (F.least("n_shingles", "y_n") * 100 >= F.greatest("n_shingles", "y_n") * F.col("percent")) & (
        F.size(F.array_intersect("least", "y_least")) * 2 >= F.least(F.size("least"), F.size("y_least")))
    other = (F.col("doc_id") != F.col("y_doc")) | (F.col("tag") != F.col("y_tag"))
    return keyed.join(first, "key").where(other & near).select(F.col("doc_id").alias("x_doc"), F.col("tag").alias("x_tag"), "y_doc", "y_tag")


def _early_classes(links: DataFrame) -> DataFrame:
    """A class for every early linked text: the least id two links away. Equal classes are truly connected."""
    one = links.groupBy(F.col("a").alias("doc_id")).agg(F.min("b").alias("class"))
    two = one.select(F.col("doc_id").alias("class"), F.col("class").alias("next"))
    return one.join(two, "class", "left").select("doc_id", F.coalesce("next", "class").alias("class"))


def _with_representative(held: DataFrame) -> DataFrame:
    """Texts with the first text of an equal shingle set (rep, rep_tag). Sets that
    one in ``HOT_SHARE`` texts or more have, ``HOT_SHARE`` sets at most, are
    joined by broadcast, so that no copy group meets in one task."""
    equal = _written(held.groupBy("one", "two").agg(F.min(F.struct("doc_id", "tag")).alias("rep"), F.count(F.lit(1)).alias("copies")), "equal")
    total = equal.agg(F.sum("copies")).first()[0] or 0
    is_hot = (F.col("copies") > 1) & (F.col("copies") * HOT_SHARE >= total)
    hot = held.join(F.broadcast(equal.where(is_hot).select("one", "two", F.col("rep").alias("hot"))), ["one", "two"], "left")
    rest = hot.where(F.col("hot").isNull()).join(equal.where(~is_hot).hint("merge"), ["one", "two"])
    both = hot.where(F.col("hot").isNotNull()).withColumnRenamed("hot", "rep").select("doc_id", "tag", "n_shingles", "least", "rep").unionByName(
        rest.select("doc_id", "tag", "n_shingles", "least", "rep"))
    return both.select("doc_id", "tag", "n_shingles", "least", F.col("rep.doc_id").alias("rep"), F.col("rep.tag").alias("rep_tag"))


def similarity_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                       percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id (least id reachable by links, itself included), one row per input row.
    Texts are linked from ``percent`` of common among all their shingles on (1 to 100).

    Words are runs without ASCII white space, A-Z lower-cased; a text of fewer
    than ``shingle`` words is one shingle. Texts without words have no shingles
    and no links, null texts too. Ids are integers; rows that share an id are
    one document, linked by any of its texts; rows with a null id take no part
    and have a null component. An empty table gives none.
    """
    texts = repeats.keyed(docs, id_col, text_col)
    n = repeats.buckets_for(texts)
    sets = _written(texts.mapInArrow(kn.tidy(_describe(shingle)), _SETS), "sets")
    held = sets.where(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0))
    held = _written(_with_representative(held), "held")
    is_rep = (F.col("doc_id") == F.col("rep")) & (F.col("tag") == F.col("rep_tag"))
    reps = held.where(is_rep).select("doc_id", "tag", "n_shingles", "least").distinct().withColumn("percent", F.lit(percent))
    early = verified(texts, _early_pairs(reps), shingle, percent, "early")

    # Texts that are no representative, or whose class is not their own id: a small part.
    classes = held.select("doc_id", "tag", is_rep.alias("_rep")).distinct().join(_early_classes(early), "doc_id", "left")
    special = _written(classes.where(~F.col("_rep") | F.col("class").isNotNull()), "special")
    marked = _beside(texts.where(F.col("doc_id").isNotNull()), special, ["doc_id", "tag"], "left")
    marked = marked.where(F.coalesce("_rep", F.lit(True))).select("doc_id", "tag", "text", F.coalesce("class", "doc_id").alias("class"))
    counts = marked.mapInArrow(kn.tidy(_deal(False, shingle, percent, 2 * n)), _DEALT).repartition(n, "bucket").mapInArrow(kn.tidy(_shared_counts(percent, 2 * n)), _packed(_COUNTS))
    left = _written(counts.repartition(n, "bucket").mapInArrow(kn.tidy(_left_over(percent)), "doc_id long, tag long, class long"), "left")

    rest = _beside(texts, left, ["doc_id", "tag"]).select("doc_id", "tag", "text", "class")
    lengths = rest.mapInArrow(kn.tidy(_deal(True, shingle, percent, 2 * n)), _DEALT).repartition(n, "bucket").mapInArrow(kn.tidy(_list_lengths(2 * n)), _packed(_LENGTHS))
    short = lengths.repartition(n, "bucket").mapInArrow(kn.tidy(_shortest(percent)), "token long, place long, doc long, tag long, class long, size long")
    pairs = short.repartition(n, "token").mapInArrow(kn.tidy(_merge(percent)), "x_doc long, x_tag long, y_doc long, y_tag long")
    late = verified(texts, pairs, shingle, percent, "late")

    twice = held.groupBy("doc_id").agg(F.collect_set("rep").alias("reps")).where(F.size("reps") > 1).select(F.array_min("reps").alias("a"), F.explode("reps").alias("b"))
    reached = component_minimum(early.unionByName(late).unionByName(twice))
    own = held.groupBy("doc_id").agg(F.min("rep").alias("rep")).join(reached, F.col("rep") == F.col("node"), "left").select(
        "doc_id", F.coalesce("label", "rep").alias("component_id"))
    return sets.join(own, "doc_id", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


kn.ship(__name__)
