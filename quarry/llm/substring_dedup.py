"""Removal of word windows that an earlier document holds, behind a count-min prefilter.

First pass: every task counts the triggers of its word windows (a window's
trigger is its minimizer, so a trigger occurs at least as often as each of its
windows) in a count-min sketch; the partition sketches are merged by adding
cells that saturate at two. Second pass: only windows whose estimate, the least
of the trigger's cells, is two or more are grouped exactly. The sketch errs
only upwards, so no repeated window is lost; a sketch too full for the corpus
lets more windows through to the exact pass and changes no result.

The merged sketch, reduced to one bit per cell, is the only data sent to all
tasks; its size is ``SKETCH_ROWS * 2**SKETCH_BITS`` bits whatever the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quarry.llm import kernels as kn
from quarry.llm import repeats

#: Cells of a sketch row, as a power of two, and rows: 16 MB in all.
SKETCH_BITS, SKETCH_ROWS = 26, 2
BLOCK_BITS = 18
#: Words hashed by the trigger; 41 grams compete in a window of 50.
GRAM = 10
_BLOCKS = "block int, salt int, cells binary, counts binary"
_OUT = "n_words long, n_removed long, spans array<struct<start:long,end:long>>, kept string"


def cells_of(triggers: np.ndarray, row: int, bits: int) -> np.ndarray:
    return kn.mix(triggers ^ np.uint64(kn.BASE_B * (row + 1) % (1 << 64))) >> np.uint64(64 - bits)


def _blocks(cells: np.ndarray, counts: np.ndarray, row: int, bits: int, salt: int) -> Iterator[dict]:
    """A sketch row cut into blocks of cells; cells of zero are left out."""
    block = (cells >> np.uint64(BLOCK_BITS)).astype(np.int64)
    cuts = np.searchsorted(block, np.arange((1 << max(0, bits - BLOCK_BITS)) + 1))
    for b in np.flatnonzero(np.diff(cuts)):
        own = slice(cuts[b], cuts[b + 1])
        yield {"block": (row << (bits - BLOCK_BITS)) + int(b), "salt": salt,
               "cells": (cells[own] & np.uint64((1 << BLOCK_BITS) - 1)).astype("<u4").tobytes(), "counts": counts[own].tobytes()}


def _as_batch(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, pa.schema([("block", pa.int32()), ("salt", pa.int32()), ("cells", pa.binary()), ("counts", pa.binary())]))


def _sketch(spec: repeats.Windows, bits: int, rows: int, fan: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = kn.Powers()
        held: list[np.ndarray] = []

        def partial():
            triggers = np.concatenate(held)
            for r in range(rows):
                cells, n = np.unique(cells_of(triggers, r, bits), return_counts=True)
                found = list(_blocks(cells, np.minimum(n, 2).astype(np.uint8), r, bits, int(triggers[0] % np.uint64(fan))))
                if found:
                    yield _as_batch(found)

        for batch in batches:
            for part in kn.slices(batch, "text"):
                found = repeats.phrases(part, spec, powers)["trigger"]
                if len(found):
                    held.append(found)
                if sum(map(len, held)) >= repeats.FLUSH:
                    yield from partial()
                    held.clear()
        if held:
            yield from partial()

    return run


def _merge(last: bool):
    """Adds the blocks of partial sketches; ``last`` turns each into one bit a cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for r in batch.to_pylist():
                total = sums.setdefault(r["block"], np.zeros(1 << BLOCK_BITS, dtype=np.uint8))
                cells = np.frombuffer(r["cells"], dtype="<u4")
                total[cells] = np.minimum(total[cells] + np.frombuffer(r["counts"], dtype=np.uint8), 2)
        for block, total in sums.items():
            if last:
                yield _as_batch([{"block": block, "salt": 0, "cells": np.packbits(total >= 2).tobytes(), "counts": b""}])
            else:
                cells = np.flatnonzero(total)
                yield _as_batch([{"block": block, "salt": 0, "cells": cells.astype("<u4").tobytes(), "counts": total[cells].tobytes()}])

    return run


def repeated_cells(source: DataFrame, spec: repeats.Windows, bits: int = SKETCH_BITS, rows: int = SKETCH_ROWS) -> np.ndarray:
    """Bits of the merged sketch's cells that count two or more, by row (packed)."""
    spark = source.sparkSession
    n = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    partial = source.mapInArrow(kn.tidy(_sketch(spec, bits, rows, n)), _BLOCKS).repartition(n, "block", "salt").mapInArrow(kn.tidy(_merge(False)), _BLOCKS)
    merged = partial.repartition(n, "block").mapInArrow(kn.tidy(_merge(True)), _BLOCKS).select("block", "cells")
    out = np.zeros((rows << (bits - BLOCK_BITS), (1 << BLOCK_BITS) // 8), dtype=np.uint8)
    for r in merged.toLocalIterator():  # at most SKETCH_ROWS * 2**SKETCH_BITS bits in all
        out[r["block"]] = np.frombuffer(bytes(r["cells"]), dtype=np.uint8)
    return out.reshape(rows, -1)


def _likely(shared, bits: int, rows: int):
    def test(triggers: np.ndarray) -> np.ndarray:
        keep = np.ones(len(triggers), dtype=bool)
        for r in range(rows):
            cells = cells_of(triggers, r, bits)
            keep &= (shared.value[r][cells >> np.uint64(3)] >> (7 - (cells & np.uint64(7))).astype(np.uint8)) & 1 == 1
        return keep

    return test


def _cut(length: int, join_words: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in kn.slices(batch, "text"):
                buf, off = kn.text_buffer(part.column("text"))
                starts, ends, first = kn.word_spans(buf, off, kn.SPACE)
                sizes, gone, spans, kept = [], [], [], []
                for r in range(part.num_rows):
                    s, e = repeats.removed_runs(part, r, length)
                    n = int(first[r + 1] - first[r])
                    whole = buf[off[r]: off[r + 1]].tobytes()
                    if join_words:
                        words = whole.split()
                        edges = [0, *np.stack([s, e], 1).ravel().tolist(), n] if len(s) else [0, n]
                        text = b" ".join(w for a, b in zip(edges[::2], edges[1::2]) for w in words[a:b])
                    elif len(s):  # a removed run goes with the space behind it
                        begin = np.append(starts[first[r]: first[r + 1]] - off[r], len(whole))
                        edges = [0, *np.stack([begin[s], begin[e]], 1).ravel().tolist(), len(whole)]
                        text = b"".join(whole[a:b] for a, b in zip(edges[::2], edges[1::2]))
                    else:
                        text = whole
                    sizes.append(n)
                    gone.append(int((e - s).sum()))
                    spans.append([{"start": a, "end": b} for a, b in zip(s.tolist(), e.tolist())])
                    kept.append(text)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in part.schema.names if c not in ("text", "tag", "starts", "counts")), pa.array(sizes, pa.int64()),
                     pa.array(gone, pa.int64()), pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                     pa.array(kept, pa.binary()).cast(pa.string())],
                    names=[*(c for c in part.schema.names if c not in ("text", "tag", "starts", "counts")), "n_words", "n_removed", "spans", "kept"])

    return run


def remove_repeated_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 50,
                            join_words: bool = True, sketch_bits: int = SKETCH_BITS, carry: Column | None = None) -> DataFrame:
    """doc_id, n_words, n_removed, spans (maximal removed runs, in words), kept,
    one row per input row.

    A word (run without ASCII white space) goes if a window of ``window`` words
    that covers it also starts in a document with a smaller doc_id. ``kept``
    is the words that stay joined by one space, or with ``join_words=False``
    the text without the removed words and the space behind them. Ids are
    integers; rows that share an id do not remove each other's words; rows with
    a null id stay whole and remove nothing. A null text has no words. ``carry``
    is passed through as the column carried.
    """
    spec = repeats.Windows(words=True, length=window, gram=min(GRAM, window), within=False)
    source = repeats.keyed(docs, id_col, text_col, *([] if carry is None else [carry.alias("carried")]))
    slim = source.where(F.col("doc_id").isNotNull()).select("doc_id", "tag", "text")
    hot = repeated_cells(slim, spec, sketch_bits)
    shared = source.sparkSession.sparkContext.broadcast(hot)
    joined = repeats.with_repeats(source, spec, _likely(shared, sketch_bits, SKETCH_ROWS))
    more = [] if carry is None else ["carried"]
    schema = StructType([source.schema["doc_id"], *(source.schema[c] for c in more), *StructType.fromDDL(_OUT).fields])
    return joined.select("doc_id", *more, "text", "starts", "counts").mapInArrow(kn.tidy(_cut(window, join_words)), schema)


kn.ship(__name__)
