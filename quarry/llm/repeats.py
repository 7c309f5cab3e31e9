"""Exact search for repeated fixed-length windows of tokens across documents.

Shared by the byte and the word operator. Windows are grouped into phrases: the
run of windows that share a minimizer, with all tokens that the run covers
(``kernels.windows_by_minimizer``). Equal windows always lie in phrases of the
same trigger (minimizer hash), which leaves three cases:

* a trigger seen once: none of its windows repeats, nothing more happens;
* the same phrase seen before: all windows of the later phrase repeat;
* one trigger, different phrases (the edges of a repeat): their windows are
  compared one by one in a second, much smaller round.

Both rounds have the same shape. Each map task first settles what it can by
itself: of equal entries only the first in corpus order leaves the task, so a
hot passage costs one entry per task, and a trigger that already has different
phrases in one task leaves it as two entries, while its phrases go to the
window round directly. What is left is dealt out by hash in packed arrays and
settled there. Corpus order is (doc_id, start).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import kernels as kn
from quarry.session import scratch_path

#: Entries a task gathers before it settles and ships them.
FLUSH = 2_000_000
SEND, REPEAT, EDGE = 0, 1, 2
#: Text behind one bucket, which a task holds in memory as packed entries of about the same size.
BUCKET_BYTES = 128 << 20
#: Public Spark setting: the shuffle files of a query go when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_DTYPES = {"trigger": "<u8", "whole": "<u8", "doc": "<i8", "tag": "<u4", "start": "<u4", "count": "<u2"}
_PACKED = "bucket int, kind int, " + ", ".join(f"{c} binary" for c in _DTYPES)
_SPAN = {"doc": "<i8", "tag": "<u4", "start": "<u4", "count": "<u2"}
_SPANS = "bucket int, kind int, " + ", ".join(f"{c} binary" for c in _SPAN)
_ROWS = "doc_id long, tag long, starts binary, counts binary"


@dataclass(frozen=True)
class Windows:
    """What repeats: ``length`` tokens in a row. ``within``: an earlier start in
    the same document counts, else only one in a smaller doc_id."""

    words: bool
    length: int
    gram: int
    within: bool


def tokens_of(part: pa.RecordBatch, spec: Windows, powers: kn.Powers) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of the rows and the rows' token offsets."""
    buf, off = kn.text_buffer(part.column("text"))
    if not spec.words:
        return kn._BYTE[buf], off
    starts, ends, rows = kn.word_spans(buf, off, kn.SPACE)
    return kn.word_hashes(buf, starts, ends, powers), rows


def phrases(part: pa.RecordBatch, spec: Windows, powers: kn.Powers) -> dict[str, np.ndarray]:
    tokens, off = tokens_of(part, spec, powers)
    row, start, count, trigger, whole = kn.windows_by_minimizer(tokens, off, spec.length, spec.gram, powers)
    return {"trigger": trigger, "whole": whole, "doc": _ints(part, "doc_id")[row], "tag": _ints(part, "tag").astype(np.uint32)[row],
            "start": start.astype(np.uint32), "count": count.astype(np.uint16)}


def _ints(part: pa.RecordBatch, name: str) -> np.ndarray:
    return part.column(name).to_numpy(zero_copy_only=False).astype(np.int64)


def _settle(x: dict[str, np.ndarray], within: bool, edges: bool, final: bool) -> list[tuple[int, dict[str, np.ndarray]]]:
    """Entries by what becomes of them. Entries equal in trigger and whole are
    one group; its first in corpus order stays, the others are repeats."""
    n = len(x["trigger"])
    order = np.argsort(x["trigger"], kind="stable")
    t = x["trigger"][order]
    shared = np.zeros(n, dtype=bool)
    shared[1:] = t[1:] == t[:-1]
    shared[:-1] |= shared[1:].copy()
    out = [] if final else [(SEND, _take(x, order[~shared]))]
    m = _take(x, order[shared])
    if len(m["trigger"]) == 0:
        return out
    m = _take(m, np.lexsort((m["whole"], m["trigger"])))
    t, w, d, s = m["trigger"], m["whole"], m["doc"], m["start"]
    new_t = np.ones(len(t), dtype=bool)
    new_t[1:] = t[1:] != t[:-1]
    new = new_t.copy()
    new[1:] |= w[1:] != w[:-1]
    at, group = np.flatnonzero(new), np.cumsum(new) - 1
    first = d == np.minimum.reduceat(d, at)[group]
    if within:
        first &= s == np.minimum.reduceat(np.where(first, s, np.uint32(0xFFFFFFFF)), at)[group]
    out.append((REPEAT, _take(m, np.flatnonzero(~first))))
    at_t, group_t = np.flatnonzero(new_t), np.cumsum(new_t) - 1
    edge = (np.add.reduceat(new, at_t)[group_t] > 1) if edges else np.zeros(len(t), dtype=bool)
    if edges:
        out.append((EDGE, _take(m, np.flatnonzero(first & edge))))
    if not final:
        two = group - group[at_t][group_t] < 2  # enough to show the others that the trigger has different phrases
        out.append((SEND, _take(m, np.flatnonzero(first & (~edge | two)))))
    return out


def _take(x: dict[str, np.ndarray], at: np.ndarray) -> dict[str, np.ndarray]:
    return {k: v[at] for k, v in x.items()}


def _planes(values: np.ndarray, kind: str) -> bytes:
    """Bytes of equal significance together, which Spark's codec then packs well."""
    return np.ascontiguousarray(values.astype(kind)).view(np.uint8).reshape(len(values), -1).T.tobytes()


def _unplanes(raw: bytes, kind: str) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, dtype=np.uint8).reshape(width, -1).T).view(kind).ravel()


def _ship(found: list[tuple[int, dict[str, np.ndarray]]], buckets: int, turn: int) -> Iterator[pa.RecordBatch]:
    for kind, x in found:
        if len(x["trigger"]) == 0:
            continue
        if kind == SEND:
            bucket = (kn.mix(x["trigger"]) % np.uint64(buckets)).astype(np.int32)
            order = np.argsort(bucket, kind="stable")
            x = _take(x, order)
            cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
        else:  # already settled: carried along to any bucket, without the hashes
            cuts = np.array([0, len(x["trigger"])])
        for b in np.flatnonzero(np.diff(cuts)):
            part = {k: v[cuts[b]: cuts[b + 1]] for k, v in x.items()}
            bare = kind != SEND
            yield pa.RecordBatch.from_pydict(
                {"bucket": pa.array([(turn * 7919) % buckets if bare else b], pa.int32()), "kind": pa.array([kind], pa.int32())}
                | {k: pa.array([b"" if bare and k in ("trigger", "whole") else _planes(part[k], d)], pa.binary()) for k, d in _DTYPES.items()})


def _gather(entries: Callable[[], Iterator[dict[str, np.ndarray]]], within: bool, edges: bool, buckets: int) -> Iterator[pa.RecordBatch]:
    held: list[dict[str, np.ndarray]] = []
    size = 0
    turn = 0
    for x in entries():
        held.append(x)
        size += len(x["trigger"])
        turn += 1 + (int(x["doc"][0]) & 0xFFFF if len(x["doc"]) else 0)
        if size >= FLUSH:
            yield from _ship(_settle(_joined(held), within, edges, final=False), buckets, turn)
            held, size = [], 0
    if held:
        yield from _ship(_settle(_joined(held), within, edges, final=False), buckets, turn)


def _joined(held: list[dict[str, np.ndarray]]) -> dict[str, np.ndarray]:
    return {k: np.concatenate([x[k] for x in held]) for k in held[0]}


def _emit_phrases(spec: Windows, buckets: int, likely) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = kn.Powers()

        def entries():
            for batch in batches:
                for part in kn.slices(batch, "text"):
                    x = phrases(part, spec, powers)
                    yield _take(x, np.flatnonzero(likely(x["trigger"]))) if likely else x

        yield from _gather(entries, spec.within, True, buckets)

    return run


def _emit_windows(spec: Windows, buckets: int) -> Callable:
    """Single windows of the edge phrases of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, bases = kn.Powers(), [kn.Powers(kn.BASE_A), kn.Powers(kn.BASE_B)]

        def entries():
            for batch in batches:
                for part in kn.slices(batch, "text"):
                    tokens, off = tokens_of(part, spec, powers)
                    docs, tags = _ints(part, "doc_id"), _ints(part, "tag").astype(np.uint32)
                    for r in range(part.num_rows):
                        at = starts_of(part, r)
                        yield from _windows(tokens[off[r]: off[r + 1]], at, spec.length, bases, docs[r], tags[r])

        yield from _gather(entries, spec.within, False, buckets)

    return run


def _windows(tokens, at, length, bases, doc, tag):
    """Hashes of the windows that start at the sorted positions ``at``, in
    pieces of a slice of tokens."""
    step = kn.SLICE_BYTES - length + 1
    for a in range(0, max(1, len(tokens) - length + 1), step):
        own = at[np.searchsorted(at, a): np.searchsorted(at, a + step)]
        if len(own):
            lo, hi = int(own[0]), int(own[-1]) + length
            one, two = kn.window_hashes(tokens[lo:hi], bases, length)
            # 96 bits tell windows apart; the zeros above take no room when shipped
            yield {"trigger": one[own - lo], "whole": two[own - lo] & np.uint64(0xFFFFFFFF), "doc": np.full(len(own), doc), "tag": np.full(len(own), tag, dtype=np.uint32),
                   "start": own.astype(np.uint32), "count": np.ones(len(own), dtype=np.uint16)}


def starts_of(part: pa.RecordBatch, row: int) -> np.ndarray:
    """Sorted distinct window starts of a row's phrases."""
    start, count = _row_spans(part, row)
    if len(start) == 0:
        return start
    return np.unique(np.repeat(start, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count))


def _row_spans(part: pa.RecordBatch, row: int) -> tuple[np.ndarray, np.ndarray]:
    start, count = part.column("starts")[row].as_py() or b"", part.column("counts")[row].as_py() or b""
    return np.frombuffer(start, dtype="<u4").astype(np.int64), np.frombuffer(count, dtype="<u2").astype(np.int64)


def removed_runs(part: pa.RecordBatch, row: int, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs (start, end) of tokens covered by the repeats of a joined row."""
    start, count = _row_spans(part, row)
    return kn.covered(start, count + length - 1)


def pack(x: dict[str, np.ndarray], kinds: dict[str, str], buckets: int, **fixed: int) -> Iterator[pa.RecordBatch]:
    """Entries dealt out by the row (doc, tag) they belong to, one packed batch for each bucket."""
    bucket = (kn.mix(x["doc"].astype(np.uint64) ^ (x["tag"].astype(np.uint64) << np.uint64(32))) % np.uint64(buckets)).astype(np.int64)
    order = np.lexsort((x["doc"], bucket))
    cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
    for b in np.flatnonzero(np.diff(cuts)):
        own = order[cuts[b]: cuts[b + 1]]
        yield pa.RecordBatch.from_pydict({k: pa.array([v], pa.int32()) for k, v in ({"bucket": b} | fixed).items()}
                                         | {c: pa.array([_planes(x[c][own], d)], pa.binary()) for c, d in kinds.items()})


def unpack(batches: Iterator[pa.RecordBatch], kinds: dict[str, str]) -> dict[str, np.ndarray] | None:
    parts = [{c: _unplanes(r[c], d) for c, d in kinds.items()} for batch in batches for r in batch.to_pylist()]
    return {c: np.concatenate([x[c] for x in parts]).astype(np.uint64 if d == "<u8" else np.int64) for c, d in kinds.items()} if parts else None


def grouped(x: dict[str, np.ndarray], *within: str) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray]:
    """Entries sorted by row and then by ``within``; first entry of each row, number of the row."""
    x = _take(x, np.lexsort((*(x[c] for c in reversed(within)), x["tag"], x["doc"])))
    new = np.ones(len(x["doc"]), dtype=bool)
    new[1:] = (x["doc"][1:] != x["doc"][:-1]) | (x["tag"][1:] != x["tag"][:-1])
    return x, np.flatnonzero(new), np.cumsum(new) - 1


def _finish(within: bool, edges: bool, buckets: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: list[dict[str, np.ndarray]] = []
        known: dict[int, list[dict[str, np.ndarray]]] = {REPEAT: [], EDGE: []}
        for batch in batches:
            for r in batch.to_pylist():
                if r["kind"] == SEND:
                    sent.append({k: _unplanes(r[k], d) for k, d in _DTYPES.items()})
                else:
                    known[r["kind"]].append({k: _unplanes(r[k], d) for k, d in _SPAN.items()})
        for kind, x in _settle(_joined(sent), within, edges, final=True) if sent else []:
            known[kind].append({k: x[k] for k in _SPAN})
        for kind, found in known.items():
            if found:
                yield from pack(_joined(found), _SPAN, buckets, kind=kind)

    return run


def _by_row(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans of each row, together."""
    if (x := unpack(batches, _SPAN)) is None:
        return
    x, at, _ = grouped(x)
    cut = np.append(at, len(x["doc"]))
    for a in range(0, len(at), 10_000):
        own = cut[a: a + 10_001]
        lists = {}
        for name, column in (("starts", "start"), ("counts", "count")):
            raw = x[column][own[0]: own[-1]].astype(_SPAN[column])
            offsets = ((own - own[0]) * raw.itemsize).astype(np.int64)
            lists[name] = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(own) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(raw)]).cast(pa.binary())
        yield pa.RecordBatch.from_pydict({"doc_id": x["doc"][own[:-1]], "tag": x["tag"][own[:-1]]} | lists)


def buckets_for(docs: DataFrame, text_col: str = "text") -> int:
    """Buckets that grow with the bytes of all texts, so that one stays within a task's memory."""
    size = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    return max(8, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET_BYTES))


def _round(source: DataFrame, emit: Callable, within: bool, edges: bool, buckets: int) -> DataFrame:
    """One round, written to the shared folder and read again."""
    dealt = source.mapInArrow(kn.tidy(emit), _PACKED).repartition(buckets, "bucket")
    spans = dealt.mapInArrow(kn.tidy(_finish(within, edges, 2 * buckets)), _SPANS)
    path = scratch_path(source.sparkSession, "repeats")
    write_and_clean(spans, path)
    return source.sparkSession.read.schema(_SPANS).parquet(path)


def write_and_clean(table: DataFrame, path: str) -> None:
    """Writes ``table``; once written, the shuffle files behind it serve nothing
    and Spark deletes them with the end of the query. ``table`` must not be run
    again, as that would repeat its shuffles."""
    conf = table.sparkSession.conf
    before = conf.get(CLEANUP)
    conf.set(CLEANUP, "true")
    try:
        table.write.parquet(path)
    finally:
        conf.set(CLEANUP, before)


def keyed(docs: DataFrame, id_col: str, text_col: str, *more: str) -> DataFrame:
    """doc_id, text and a tag of the text, which tells apart rows that share an id."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), *more,
                       F.xxhash64(F.col(text_col)).bitwiseAND(F.lit(0xFFFFFFFF)).alias("tag"))


def _collected(spans: DataFrame, buckets: int) -> DataFrame:
    return spans.repartition(buckets, "bucket").mapInArrow(kn.tidy(_by_row), _ROWS)


def with_repeats(source: DataFrame, spec: Windows, likely=None) -> DataFrame:
    """``source`` (of ``keyed``) with the columns starts and counts: packed runs
    of window starts that repeat (null if none). Rows with a null id neither
    repeat nor are repeated. ``likely`` may rule out triggers that occur once.
    """
    slim = source.where(F.col("doc_id").isNotNull()).select("doc_id", "tag", "text")
    buckets = buckets_for(slim)
    spans = _round(slim, _emit_phrases(spec, buckets * 2, likely), spec.within, True, buckets)
    edge = _collected(spans.where(F.col("kind") == EDGE), buckets)
    texts = slim.join(edge.hint("merge"), ["doc_id", "tag"])
    single = _round(texts.select("doc_id", "tag", "text", "starts", "counts"), _emit_windows(spec, buckets * 2), spec.within, False, buckets)
    repeats = _collected(spans.where(F.col("kind") == REPEAT).unionByName(single), buckets)
    known, unknown = source.where(F.col("doc_id").isNotNull()), source.where(F.col("doc_id").isNull())
    runs = [F.lit(None).cast("binary").alias(c) for c in ("starts", "counts")]
    # null ids stay out of the join, where they would meet in one task
    return known.join(repeats.hint("merge"), ["doc_id", "tag"], "left").unionByName(unknown.select("*", *runs))


kn.ship(__name__)
