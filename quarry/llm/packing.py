"""Packing by power-of-two decomposition.

Each document's token ids are cut into as many full sequences as fit and then
into pieces whose lengths are the binary digits of the rest. A piece is a
sequence of its own: its length is a power of two, so batches are made of equal
lengths (``bucket``), nothing is padded and no sequence crosses documents.
Tokenizing and cutting need no shuffle; the work is one pass over the rows.
"""

from __future__ import annotations

import json
import os
import unicodedata
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm import kernels as kn

#: Distinct chunks and ids a task remembers before it drops the half it used least; bytes of text and new chunks it encodes at once.
CACHE_CHUNKS, CACHE_IDS, SLICE_BYTES, LEARN_CHUNKS = 500_000, 3_000_000, 1 << 19, 10_000
#: Marks that end a chunk without being part of a contraction, and what may stand before them.
MARKS = b".,;:!?"
CLOSED = frozenset(bytes([c]) for c in b"abcdefghijklmnopqrstuvwxyz0123456789")


class ChunkEncoder:
    """Ids of texts by way of their space-separated chunks.

    The tokenizer lower-cases, drops white space, and its pre-tokens never hold
    any, so the ids of a text are those of its chunks in turn; each distinct
    chunk is encoded once while it is remembered. Chunks of plain letters are
    one pre-token each; they are encoded together, without the normalizer that
    has nothing to do there, and told apart by the ids that end a word.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks side by side
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        steps = self.tokenizer.pre_tokenizer
        level = steps[len(json.loads(steps.__getstate__())["pretokenizers"]) - 1]
        self.plain = Tokenizer(self.tokenizer.model)  # both use one model in memory
        self.plain.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), level])
        words = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(words.values()) + 1, dtype=bool)
        self.ends_word[[i for w, i in words.items() if w.endswith("</w>")]] = True
        del words
        self.forget()
        kn.give_back()  # the vocabulary was read in many small parts

    def forget(self) -> None:
        self.codes: dict[bytes, int] = {}
        self.flat = np.zeros(1 << 16, dtype=np.uint32)
        self.ends = np.zeros(1 << 14, dtype=np.int64)
        self.uses = np.zeros(0, dtype=np.int64)
        self.used = 0

    def _make_room(self) -> None:
        """Drop the chunks used least: most of a text's distinct chunks come once."""
        uses = np.concatenate([self.uses, np.zeros(len(self.codes) - len(self.uses), dtype=np.int64)])
        most = np.argsort(-uses, kind="stable")[: CACHE_CHUNKS // 2]
        ids, upto = self._ids(most)
        chunks = list(self.codes)  # in the order of their codes
        self.forget()
        if len(ids) <= CACHE_IDS // 2:
            self._store([chunks[i] for i in most.tolist()], ids, np.diff(upto))

    def _store(self, chunks: list[bytes], ids: np.ndarray, sizes: np.ndarray) -> None:
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.flat[self.used: self.used + len(ids)] = ids
        first = len(self.codes)
        while first + len(chunks) + 1 > len(self.ends):
            self.ends = np.concatenate([self.ends, np.zeros_like(self.ends)])
        self.ends[first + 1: first + len(chunks) + 1] = self.used + np.cumsum(sizes)
        self.used += len(ids)
        self.codes.update(zip(chunks, range(first, first + len(chunks))))

    def _learn(self, chunks: list[bytes]) -> None:
        plain, other = [], []
        for c in chunks:
            (plain if c.islower() and c.isalpha() or is_plain(c) else other).append(c)
        if plain:
            ids = np.array(self.plain.encode_batch_fast([b" ".join(plain).decode()], add_special_tokens=False)[0].ids, dtype=np.uint32)
            last = np.flatnonzero(self.ends_word[ids])
            if len(last) == len(plain) and last[-1] == len(ids) - 1:
                self._store(plain, ids, np.diff(last, prepend=-1))
            else:
                other += plain
        if other:
            texts = [c.decode("utf-8", "replace") for c in other]
            found = [np.array(x.ids, dtype=np.uint32) for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
            self._store(other, np.concatenate(found), np.array([len(x) for x in found]))

    def _learn_marked(self, chunks: list[bytes]) -> None:
        """Chunks of a letter or digit and closing marks behind it: two pre-token runs."""
        parts = [p for c in chunks for p in (c[: len(c.rstrip(MARKS))], c[len(c.rstrip(MARKS)):])]
        if missing := {p for p in parts if p not in self.codes}:
            self._learn(list(missing))
        ids, off = self._ids(np.array([self.codes[p] for p in parts]))
        self._store(chunks, ids, np.diff(off[::2]))

    def _ids(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        begin = self.ends[codes]
        length = self.ends[codes + 1] - begin
        upto = np.concatenate([[0], np.cumsum(length)])
        return self.flat[np.repeat(begin - upto[:-1], length) + np.arange(upto[-1])], upto

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and the offsets of the texts."""
        if len(self.codes) > CACHE_CHUNKS or self.used > CACHE_IDS:
            self._make_room()
        chunks: list[bytes] = []
        sizes = []
        for text in texts:
            own = (text if b"<|" in text else text.lower()).split()  # bytes: ASCII letters and ASCII white space only
            chunks += own
            sizes.append(len(own))
        codes = np.fromiter(map(self.codes.get, chunks, repeat(-1)), dtype=np.int64, count=len(chunks))
        if len(unknown := np.flatnonzero(codes < 0).tolist()):
            missing = {chunks[i] for i in unknown}
            marked = [c for c in missing if len(body := c.rstrip(MARKS)) < len(c) and body[-1:] in CLOSED]
            rest = list(missing.difference(marked))
            for at in range(0, len(rest), LEARN_CHUNKS):
                self._learn(rest[at: at + LEARN_CHUNKS])
            marked = [c for c in marked if c not in self.codes]
            for at in range(0, len(marked), LEARN_CHUNKS):
                self._learn_marked(marked[at: at + LEARN_CHUNKS])
            codes[unknown] = [self.codes[chunks[i]] for i in unknown]
        counts = np.bincount(codes, minlength=len(self.codes))
        counts[: len(self.uses)] += self.uses
        self.uses = counts
        ids, upto = self._ids(codes)
        return ids, upto[np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])]


def worker_encoder(path: str) -> ChunkEncoder:
    """One encoder for all tasks that a Python worker runs; the chunks it remembers go with the task."""
    held = kn.held()
    if path not in held:
        held[path] = ChunkEncoder(path)
    return held[path]


def is_plain(chunk: bytes) -> bool:
    """Lower-case letters of Latin blocks, composed: surely one pre-token."""
    text = chunk.decode("utf-8", "replace")
    return text.isalpha() and max(text) < "\u0250" and text == text.lower() and unicodedata.is_normalized("NFC", text)


def piece_lengths(n: int, most: int) -> list[int]:
    """Full sequences, then the binary digits of the rest from the largest."""
    out = [most] * (n // most)
    rest = n % most
    return out + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def _pack(path: str, end_id: int, most: int, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(path)
        try:
            for batch in batches:
                for part in kn.slices(batch, "text", SLICE_BYTES):
                    texts = [x or b"" for x in part.column("text").cast(pa.binary()).to_pylist()]
                    ids, off = encoder.encode(texts)
                    rows, start, length, piece, total = [], [], [], [], []
                    for r in range(len(texts)):
                        own = np.append(ids[off[r]: off[r + 1]], np.uint32(end_id)).astype("<u4").tobytes()
                        n, at = len(own) // 4, 0
                        for size in piece_lengths(n, most):
                            rows.append(r)
                            start.append(at)
                            length.append(size)
                            piece.append(own[4 * at: 4 * (at + size)])
                            total.append(n)
                            at += size
                    yield pa.RecordBatch.from_arrays(
                        [part.column("doc_id").take(pa.array(rows, pa.int64())), pa.array(start, pa.int64()),
                         pa.array(length, pa.int64()), pa.array(piece, pa.binary()), pa.array(total, pa.int64())],
                        schema=schema)
        finally:  # the worker lives on beside others: of the encoder only the model stays, and nothing half learned
            encoder.forget()
            kn.give_back()

    return run


def pack_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                   max_length: int = 4096, end_id: int = 2) -> DataFrame:
    """Pieces of at most ``max_length`` (a power of two) token ids, one per row.

    Returns doc_id, start (ids of the document before the piece), length, ids
    (little-endian unsigned 32-bit), doc_tokens (with the end id), bucket (log2
    of the length), sequence_id (one per piece, unique in the result), offset
    (always 0). A null or empty text is the end id alone. Rows are packed one
    by one: repeated rows and null ids give their own pieces, an empty table
    gives none.
    """
    if max_length < 1 or max_length & (max_length - 1):
        raise ValueError("max_length must be a power of two")
    kind = docs.schema[id_col].dataType
    spark_schema = T.StructType([T.StructField("doc_id", kind), T.StructField("start", T.LongType()),
                                 T.StructField("length", T.LongType()), T.StructField("ids", T.BinaryType()),
                                 T.StructField("doc_tokens", T.LongType())])
    from pyspark.sql.pandas.types import to_arrow_schema

    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    pieces = source.mapInArrow(_pack(tokenizer_path, end_id, max_length, to_arrow_schema(spark_schema)), spark_schema)
    return pieces.select("*", F.log2("length").cast("int").alias("bucket"),
                         F.monotonically_increasing_id().alias("sequence_id"), F.lit(0).cast("long").alias("offset"))


kn.ship(__name__)
