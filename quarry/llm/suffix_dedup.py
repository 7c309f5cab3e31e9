"""Removal of repeated byte strings by prefix-free parsing.

A rolling hash puts a trigger wherever it is least among the grams of a
100-byte window; the triggers cut every text into phrases that overlap by one
window, so that each 100-byte string lies inside a phrase and equal strings lie
at equal places of phrases with the same trigger. The dictionary is the set of
distinct phrases, the parse their occurrences in corpus order (doc_id, start).
A phrase that the parse holds before is removed whole. No suffix array is
built: removal asks only whether two suffixes agree in their first 100 bytes,
so where one trigger has several dictionary phrases, their windows are grouped
by a 96-bit fingerprint of those bytes, and the first of each group in corpus
order stays. Highly repetitive text has few dictionary phrases and almost all
work ends there.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from quarry.llm import kernels as kn
from quarry.llm import repeats

#: Bytes hashed by the trigger; 61 grams compete in a window of 100.
GRAM = 40
_OUT = "doc_id long, n_bytes long, n_removed long, spans array<struct<start:long,end:long>>, kept binary"


def _cut(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in kn.slices(batch, "text"):
                buf, off = kn.text_buffer(part.column("text"))
                sizes, gone, spans, kept = [], [], [], []
                for r in range(part.num_rows):
                    own = buf[off[r]: off[r + 1]]
                    s, e = repeats.removed_runs(part, r, length)
                    edges = np.concatenate([[0], np.stack([s, e], 1).ravel(), [len(own)]]) if len(s) else np.array([0, len(own)])
                    kept.append(b"".join(own[a:b].tobytes() for a, b in edges.reshape(-1, 2)))
                    spans.append([{"start": a, "end": b} for a, b in zip(s.tolist(), e.tolist())])
                    sizes.append(len(own))
                    gone.append(int((e - s).sum()))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(gone, pa.int64()),
                     pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array(kept, pa.binary())],
                    names=["doc_id", "n_bytes", "n_removed", "spans", "kept"])

    return run


def remove_repeated_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 100) -> DataFrame:
    """doc_id, n_bytes, n_removed, spans (maximal removed runs, in bytes) and
    kept (the bytes that stay, in order), one row per input row.

    A byte goes if a string of ``length`` bytes that covers it also starts
    earlier: in a smaller doc_id, or earlier in the same document. Ids are
    integers. A null text is empty. Rows that share an id are one document in
    corpus order, so exact repeats of a row do not remove each other; rows with
    a null id stay whole and remove nothing. An empty table gives none.
    """
    spec = repeats.Windows(words=False, length=length, gram=min(GRAM, length), within=True)
    joined = repeats.with_repeats(repeats.keyed(docs, id_col, text_col), spec)
    return joined.select("doc_id", "text", "starts", "counts").mapInArrow(kn.tidy(_cut(length)), _OUT)


kn.ship(__name__)
