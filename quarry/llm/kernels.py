"""Array helpers that run inside Spark tasks: words, rolling hashes, minimizers.

All functions work on the UTF-8 bytes of a slice of an Arrow batch. A slice
holds at most ``SLICE_BYTES`` of text (one longer text forms a slice alone and
is cut into overlapping pieces where tables of powers are needed), so memory
per task does not depend on the partition.
"""

from __future__ import annotations

import ctypes
import hashlib
import sys
from collections.abc import Callable, Iterator
from types import ModuleType

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

SLICE_BYTES = 1 << 21
#: Odd multipliers of the polynomial hashes and of the final mixing.
BASE_A = 0x9E3779B97F4A7C15
BASE_B = 0xD6E8FEB86659FD95
MIX_1 = 0xBF58476D1CE4E5B9
MIX_2 = 0x94D049BB133111EB


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(MIX_1)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(MIX_2)
    return x ^ (x >> np.uint64(31))


def seeded(seed: int, n: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit values."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(BASE_A) + np.uint64(seed))


class Powers:
    """Powers of an odd base and of its inverse modulo 2**64, grown on demand."""

    def __init__(self, base: int = BASE_A):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(0, dtype=np.uint64)

    def reach(self, n: int) -> None:
        if len(self.up) < n:
            n = max(n, 1 << 16)
            self.up = np.full(n, self.base, dtype=np.uint64)
            self.down = np.full(n, self.inverse, dtype=np.uint64)
            self.up[0] = self.down[0] = 1
            np.cumprod(self.up, out=self.up)
            np.cumprod(self.down, out=self.down)

    def prefix(self, tokens: np.ndarray) -> np.ndarray:
        """P with P[j] - P[i] = sum of tokens[x] * base**x for i <= x < j."""
        self.reach(len(tokens) + 1)
        out = np.zeros(len(tokens) + 1, dtype=np.uint64)
        np.cumsum(tokens * self.up[: len(tokens)], out=out[1:])
        return out

    def span(self, prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of tokens[start:end], the same wherever the span lies."""
        return (prefix[end] - prefix[start]) * self.down[start]

    def grams(self, prefix: np.ndarray, k: int) -> np.ndarray:
        """Hashes of all runs of k tokens."""
        n = len(prefix) - k
        return (prefix[k:] - prefix[:-k]) * self.down[:n] if n > 0 else np.zeros(0, dtype=np.uint64)


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, dtype=np.int64)[column.offset: column.offset + len(column) + 1] if len(column) else np.zeros(1, dtype=np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return raw[off[0]: off[-1]], off - off[0]


def slices(batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Rows of a batch in runs of at most ``most`` bytes of text (at least one row)."""
    off = text_buffer(batch.column(column))[1]  # its bytes may be a copy, which must not live as long as the batch
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(off, off[at] + most, side="right")) - 1)
        yield batch.slice(at, to - at)
        at = to


def byte_class(characters: bytes) -> np.ndarray:
    """Table of 256 booleans: True for these bytes."""
    table = np.zeros(256, dtype=bool)
    table[list(characters)] = True
    return table


SPACE = byte_class(b" \t\n\x0b\x0c\r")
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"): ord("Z") + 1] += 32


def word_spans(buf: np.ndarray, off: np.ndarray, separator: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte start and end of every word, and the first word of every row
    (rows + 1 entries). Words are maximal runs of bytes that are no separator;
    none crosses rows."""
    if len(buf) == 0:
        e = np.zeros(0, dtype=np.int64)
        return e, e, np.zeros(len(off), dtype=np.int64)
    inside = ~separator[buf]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    cuts = off[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(buf))]
    first[cuts] = inside[cuts]
    last[cuts - 1] = inside[cuts - 1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, off)


_BYTE = seeded(11, 256)


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, powers: Powers) -> np.ndarray:
    """64-bit hash of every word."""
    out = np.empty(len(starts), dtype=np.uint64)
    at = 0
    while at < len(starts):
        to = int(np.searchsorted(ends, starts[at] + SLICE_BYTES, side="right"))
        if to <= at:  # one word longer than a slice
            digest = hashlib.blake2b(buf[starts[at]: ends[at]].tobytes(), digest_size=8).digest()
            out[at], at = np.frombuffer(digest, dtype=np.uint64)[0], at + 1
            continue
        base = starts[at]
        prefix = powers.prefix(_BYTE[buf[base: ends[to - 1]]])
        s, e = starts[at:to] - base, ends[at:to] - base
        out[at:to] = mix(powers.span(prefix, s, e) + (e - s).astype(np.uint64))
        at = to
    return out


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive entries, by doubling."""
    n = len(x) - width + 1
    if n <= 0:
        return x[:0]
    span = 1
    while span * 2 <= width:
        x = np.minimum(x[: len(x) - span], x[span:])
        span *= 2
    return np.minimum(x[:n], x[width - span: width - span + n])


_POS = 24


def windows_by_minimizer(tokens: np.ndarray, off: np.ndarray, window: int, k: int, powers: Powers):
    """Windows of ``window`` consecutive tokens, grouped into runs that share
    their minimizer (the leftmost k-gram of least hash inside the window).

    Returns per run: row, first window start within the row, number of
    consecutive window starts, hash of the minimizer, hash of all tokens the
    run covers. Equal windows have equal minimizers at the same offset, so two
    equal windows always lie in runs with the same minimizer hash. Long inputs
    are cut into pieces that overlap by window - 1 tokens: every window still
    lies in exactly one run.
    """
    parts: list[tuple] = []
    rows = len(off) - 1
    row = 0
    while row < rows:
        to = max(row + 1, int(np.searchsorted(off, off[row] + SLICE_BYTES, side="right")) - 1)
        lo, hi = int(off[row]), int(off[to])
        if hi - lo <= SLICE_BYTES:
            parts.append(_runs(tokens[lo:hi], off[row: to + 1] - lo, row, 0, window, k, powers))
        else:
            step = SLICE_BYTES - window + 1
            for a in range(lo, max(lo + 1, hi - window + 1), step):
                piece = tokens[a: min(hi, a + SLICE_BYTES)]
                parts.append(_runs(piece, np.array([0, len(piece)]), row, a - lo, window, k, powers))
        row = to
    if not parts:
        z = np.zeros(0, dtype=np.int64)
        return z, z, z, z.astype(np.uint64), z.astype(np.uint64)
    return tuple(np.concatenate(c) for c in zip(*parts))


def _runs(tokens, off, first_row, shift, window, k, powers):
    n = len(tokens)
    z = np.zeros(0, dtype=np.int64)
    if n < window:
        return z, z, z, z.astype(np.uint64), z.astype(np.uint64)
    prefix = powers.prefix(tokens)
    grams = mix(powers.grams(prefix, k))
    key = (grams >> np.uint64(_POS) << np.uint64(_POS)) | np.arange(len(grams), dtype=np.uint64)
    best = (sliding_min(key, window - k + 1) & np.uint64((1 << _POS) - 1)).astype(np.int64)
    change = np.zeros(n + 2, dtype=np.int32)
    lengths = np.diff(off)
    full = lengths >= window
    np.add.at(change, off[:-1][full], 1)
    np.add.at(change, off[1:][full] - window + 1, -1)
    valid = np.flatnonzero(np.cumsum(change)[: len(best)] > 0)
    if len(valid) == 0:
        return z, z, z, z.astype(np.uint64), z.astype(np.uint64)
    anchor = best[valid]
    new = np.ones(len(valid), dtype=bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (valid[1:] != valid[:-1] + 1)
    at = np.flatnonzero(new)
    start, count = valid[at], np.diff(np.append(at, len(valid)))
    whole = mix(powers.span(prefix, start, start + count + window - 1) ^ count.astype(np.uint64))
    row = np.searchsorted(off, start, side="right") - 1
    return row + first_row, start - off[row] + shift, count, grams[anchor[at]], whole


def window_hashes(tokens: np.ndarray, powers: list[Powers], window: int) -> list[np.ndarray]:
    """One hash per base of every window of ``window`` tokens."""
    return [mix(p.grams(p.prefix(tokens), window)) for p in powers]


def covered(starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs (start, end) of the union of intervals; touching ones merge."""
    if len(starts) == 0:
        return starts, starts
    order = np.argsort(starts, kind="stable")
    s = starts[order]
    e = np.maximum.accumulate(s + lengths[order])
    cut = np.ones(len(s), dtype=bool)
    cut[1:] = s[1:] > e[:-1]
    at = np.flatnonzero(cut)
    return s[at], e[np.append(at[1:] - 1, len(s) - 1)]


#: Stands for a module in a Python worker; its names hold what tasks keep for later ones.
_HELD = "quarry_worker_held"


def held() -> dict:
    """What the tasks of one operator keep in a Python worker for its next tasks."""
    return sys.modules.setdefault(_HELD, ModuleType(_HELD)).__dict__


def give_back() -> None:
    """Memory that a task has freed goes back to the system, as its worker lives on."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError, TypeError):  # another C library
        pass


def tidy(task: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``task`` in a worker that others have used and will use: what they hold
    there is dropped first, and freed memory is given back at the end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sys.modules.pop(_HELD, None)
        try:
            yield from task(batches)
        finally:
            give_back()

    return run


def ship(name: str) -> None:
    """Send the functions of a module with the task, so that Python workers
    need no access to this package's folder. A module that these refer to goes
    along with all it refers to, so the whole package is sent by value."""
    cloudpickle.register_pickle_by_value(sys.modules[name.partition(".")[0]])


ship(__name__)
