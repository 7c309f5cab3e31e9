import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from quarry.llm import packing
from quarry.llm import queries as Q

PATH = public_tokenizers.path("word_bpe_49k.json")
SF = "/root/testdata/sf0.001"


def rebuilt(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r.doc_id, r.start)):
        ids = np.frombuffer(bytes(r.ids), dtype="<u4")
        assert len(ids) == r.length and r.length == 1 << r.bucket and r.offset == 0
        assert len(out.setdefault(r.doc_id, [])) == r.start
        out[r.doc_id] += ids.tolist()
    return out


def test_round_trip_against_the_tokenizer(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = packing.pack_documents(docs, PATH).collect()
    got = rebuilt(rows)
    t = Tokenizer.from_file(PATH)
    for d in docs.collect():
        assert got[d.doc_id] == t.encode(d.text or "", add_special_tokens=False).ids + [2], d.doc_id
    assert len({r.sequence_id for r in rows}) == len(rows)
    assert all(r.doc_tokens == len(got[r.doc_id]) for r in rows)


def test_odd_texts_and_repeated_rows(spark, documents):
    texts = [None, "", " \t\n", "a", "don't  STOP!!", "x\u00a0y\u2003z\x1cw\u0085v", "e\u0301 \u0301x ΟΔΟΣ İ", "<|endoftext|> a<|startoftext|>b",
             "ab" * 40_000, "word " * 30_000, "中文字 \U0001f600 １２3", "\x00 null"]
    rows = [(i, x) for i, x in enumerate(texts)] + [(3, "a"), (None, "b")]
    out = packing.pack_documents(documents(rows), PATH).collect()
    t = Tokenizer.from_file(PATH)
    once = rebuilt([r for r in out if r.doc_id not in (3, None)])
    for i, x in enumerate(texts):
        if i != 3:
            assert once[i] == t.encode(x or "", add_special_tokens=False).ids + [2], i
    assert len([r for r in out if r.doc_id == 3]) == 2 * len([1 for n in packing.piece_lengths(2, 4096)])
    assert [r.length for r in out if r.doc_id is None] == [2]


def test_piece_lengths_are_the_binary_digits():
    assert packing.piece_lengths(2 * 4096 + 13, 4096) == [4096, 4096, 8, 4, 1]
    with pytest.raises(ValueError):
        packing.pack_documents(None, PATH, max_length=1000)


def test_empty_table(spark, documents):
    out = packing.pack_documents(documents([(1, "a")]).limit(0), PATH)
    assert out.count() == 0 and "sequence_id" in out.columns


def test_query_digest(spark):
    rows = Q.QUERIES["op9_packing"](spark, SF).collect()
    t = Tokenizer.from_file(PATH)
    docs = {d.doc_id: d.text for d in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in rows[:300]:
        ids = t.encode(docs[r.doc_id], add_special_tokens=False).ids + [2]
        assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start: r.start + r.length], dtype="<u4").tobytes())
        assert r.doc_tokens == len(ids)


def test_other_tasks_drop_the_encoder_of_the_worker():
    """Python workers live on: an encoder that packing left there must not stand beside the Jaccard join's memory."""
    from quarry.llm import jaccard_join, kernels
    encoder = packing.worker_encoder(PATH)
    assert packing.worker_encoder(PATH) is encoder and PATH in kernels.held()
    batch = pa.RecordBatch.from_pydict({"doc_id": [1], "tag": [0], "text": ["one two three four five"]})
    alone = [b.to_pylist() for b in jaccard_join._describe(4)(iter([batch]))]
    assert [b.to_pylist() for b in kernels.tidy(jaccard_join._describe(4))(iter([batch]))] == alone
    assert PATH not in kernels.held()


def test_a_task_leaves_the_model_alone_in_its_worker():
    """Two workers beside 1800 MB of heap: of packing only the model, once, may stay when the task ends or breaks off."""
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()), ("doc_tokens", pa.int64())])
    batch = pa.RecordBatch.from_pydict({"doc_id": [1, 2, 3], "text": ["one two, three", None, "two four!"]})
    encoder = packing.worker_encoder(PATH)
    rows = [r for b in packing._pack(PATH, 2, 4096, schema)(iter([batch])) for r in b.to_pylist()]
    assert [r["doc_id"] for r in rows if r["start"] == 0] == [1, 2, 3]
    assert packing.worker_encoder(PATH) is encoder and not encoder.codes and encoder.used == 0

    task = packing._pack(PATH, 2, 4096, schema)(iter([batch, batch]))
    next(task)
    task.close()
    assert not encoder.codes and encoder.used == 0


def test_remembered_chunks_are_bounded_and_the_most_used_stay(monkeypatch):
    monkeypatch.setattr(packing, "CACHE_CHUNKS", 200)
    monkeypatch.setattr(packing, "LEARN_CHUNKS", 7)
    encoder, t = packing.ChunkEncoder(PATH), Tokenizer.from_file(PATH)
    texts = [f"the cat, {' '.join(f'w{k}x word{k}. zq{chr(97 + k % 26)}{chr(97 + k // 26 % 26)}' for k in range(i, i + 30))} the cat" for i in range(0, 900, 30)]
    held = 0
    for text in texts:
        ids, off = encoder.encode([text.encode(), b"the cat"])
        want = [t.encode(x, add_special_tokens=False).ids for x in (text, "the cat")]
        assert [ids[off[k]: off[k + 1]].tolist() for k in (0, 1)] == want
        held = max(held, len(encoder.codes))
        if len(encoder.codes) > packing.CACHE_CHUNKS:
            encoder._make_room()
            assert {b"the", b"cat"} <= encoder.codes.keys() and len(encoder.codes) == packing.CACHE_CHUNKS // 2
    assert held < packing.CACHE_CHUNKS + 300 and len(encoder.flat) <= 1 << 16
