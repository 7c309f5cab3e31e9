"""Trie of the shared beginnings of conversations, without rebuilding a text.

A sequence of turns is known by its product in a monoid: a turn t stands for
the map x -> x B + t, and a sequence for the composition of its turns' maps, so
that the product of two sequences in a row follows from theirs. One running
product over the stored turns is all that is read from texts. A rebuilt
conversation is the head of another one and the rest of its own turns; each of
its beginnings has the product own(j) + (head - own(h)) B^(j - h), where own(j)
is the running product of its own first j turns: two numbers a conversation, and
no turn is copied.

Beginnings of equal depth and product are one node. That is verified: members
of a node must agree in the product of their parent, and the stored turns that
they refer to as their last one must be equal; by induction on the depth they
are then equal as a whole. Should two different ones ever meet, all is done
again with another seed.

Sums over subtrees need no step per level. A node belongs to its smallest
member, so that each conversation owns one run of depths and hangs, by the
first of them, on a run of a smaller one. Sums over these runs are gathered by
pointer doubling, in as many rounds as the logarithm of the tree of runs is
high; a running sum along each run gives the rest.

Running products and sums are scans in two steps: sorted range partitions are
scanned by themselves and written; what a partition hands to the next one is a
row a partition on the driver. A conversation may span any number of
partitions.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm import kernels as kn
from quarry.llm.columns import space_words
from quarry.session import scratch_path

#: Conversations of a family share the head of its first; a head has fewer than ``HEADS`` turns.
FAMILY, HEADS = 20, 4
BASES = (kn.BASE_A, kn.BASE_B)
#: Ids of a piece that is digested in one go.
PIECE = 4096
SEEDS = 5
_EMPTY = hashlib.sha256(b"").hexdigest()
_WORD = (1 << 64) - 1
_SCAN = [T.StructField(c, T.LongType()) for c in ("at", "a1", "a2", "b1", "b2")]


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, f"trie-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _numbers(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False).astype(np.int64)


def power(base: int, exponents: np.ndarray) -> np.ndarray:
    """``base`` to each exponent, modulo 2**64."""
    out, square, left = np.ones(len(exponents), dtype=np.uint64), base, exponents.astype(np.uint64)
    while left.any():
        out = np.where(left & np.uint64(1) > 0, out * np.uint64(square), out)
        square, left = square * square & _WORD, left >> np.uint64(1)
    return out


def _extended(batch: pa.RecordBatch, columns: dict[str, np.ndarray], drop: str | None = None) -> pa.RecordBatch:
    names = [c for c in batch.schema.names if c != drop and c not in columns]
    return pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), *(pa.array(v.view(np.int64)) for v in columns.values())], names=[*names, *columns])


def _local(group: str, values: tuple[str, str], bases: tuple[int, int]):
    """Scan of one partition: place in the group, product with and without the row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = [kn.Powers(b) for b in bases]
        last, count, carry = None, 0, [0, 0]
        for batch in batches:
            if batch.num_rows == 0:
                continue
            key, n = _numbers(batch, group), batch.num_rows
            new = np.ones(n, dtype=bool)
            new[1:] = key[1:] != key[:-1]
            start = np.maximum.accumulate(np.where(new, np.arange(n), 0))
            place = np.arange(n) - start
            goes_on = start == 0 if last == key[0] else np.zeros(n, dtype=bool)  # rows of the group that the last batch ended in
            out = {"at": place + 1 + np.where(goes_on, count, 0)}
            for k, (p, column) in enumerate(zip(powers, values)):
                p.reach(n + 1)
                sums = np.concatenate([[np.uint64(0)], np.cumsum(_numbers(batch, column).view(np.uint64) * p.down[place])])
                whole = (sums[1:] - sums[start]) * p.up[place]
                whole = np.where(goes_on, whole + np.uint64(carry[k]) * p.up[place + 1], whole)
                before = np.concatenate([[np.uint64(0)], whole[:-1]])
                before[new] = 0
                if goes_on[0]:
                    before[0] = np.uint64(carry[k])
                out |= {f"a{k + 1}": whole, f"b{k + 1}": before}
            last, count, carry = key[-1], int(out["at"][-1]), [int(out["a1"][-1]), int(out["a2"][-1])]
            yield _extended(batch, {c: out[c] for c in ("at", "a1", "a2", "b1", "b2")})

    return run


def _carried(group: str, carries: dict[int, tuple[int, int, int, int]], bases: tuple[int, int]):
    """Adds to the first group of a partition what came before it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            key, part = _numbers(batch, group), _numbers(batch, "_part")
            at = _numbers(batch, "at")
            out = {"at": at.copy()} | {c: _numbers(batch, c).view(np.uint64).copy() for c in ("a1", "a2", "b1", "b2")}
            for p in np.unique(part).tolist():
                if p in carries:
                    conv, n, *sums = carries[p]
                    own = np.flatnonzero((part == p) & (key == conv))
                    out["at"][own] += n
                    for k, (base, s) in enumerate(zip(bases, sums)):
                        out[f"a{k + 1}"][own] += np.uint64(s) * power(base, at[own])
                        out[f"b{k + 1}"][own] += np.uint64(s) * power(base, at[own] - 1)
            yield _extended(batch, out, drop="_part")

    return run


class Running:
    """Running products of ``values`` over the rows of each group (a long
    column) in order: at (place from 1), a1, a2 (with the row), b1, b2 (without).
    Products of base 1 are sums."""

    def __init__(self, df: DataFrame, group: str, order: list, values: tuple[str, str], bases: tuple[int, int] = BASES):
        keys = [F.col(group), *order]
        n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        dealt = df.repartitionByRange(n, *keys).sortWithinPartitions(*keys).withColumn("_part", F.spark_partition_id())
        schema = T.StructType([*dealt.schema.fields, *_SCAN])
        self.group, self.bases = group, bases
        self.stored = _written(dealt.mapInArrow(_local(group, values, bases), schema), "scan")
        last = F.max(F.struct(F.col(group).alias("g"), "at", "a1", "a2")).alias("last")
        ends = self.stored.groupBy("_part").agg(F.min(group).alias("first"), last).collect()  # a row a partition
        self.carries: dict[int, tuple[int, int, int, int]] = {}
        before = None
        for r in sorted(ends, key=lambda r: r["_part"]):
            own = (r["last"]["g"], r["last"]["at"], r["last"]["a1"] & _WORD, r["last"]["a2"] & _WORD)
            if before and before[0] == r["first"]:
                self.carries[r["_part"]] = before
                if own[0] == r["first"]:
                    own = (own[0], before[1] + own[1], *((b * pow(x, own[1], 1 << 64) + o) & _WORD for b, o, x in zip(before[2:], own[2:], bases)))
            before = own

    def select(self, *columns: str) -> DataFrame:
        """The group, ``columns`` and the running values."""
        found = self.stored.select("_part", self.group, *columns, *(f.name for f in _SCAN))
        schema = T.StructType([f for f in found.schema.fields if f.name != "_part"])
        return found.mapInArrow(_carried(self.group, self.carries, self.bases), schema)


def _shift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Own turns behind the head: products of the rebuilt beginnings."""
    for batch in batches:
        far = _numbers(batch, "at") - _numbers(batch, "h")
        out = {"depth": _numbers(batch, "n_head") + far}
        for k, base in enumerate(BASES, 1):
            change = _numbers(batch, f"g{k}").view(np.uint64) - _numbers(batch, f"o{k}").view(np.uint64)
            out[f"k{k}"] = _numbers(batch, f"a{k}").view(np.uint64) + change * power(base, far)
            out[f"p{k}"] = _numbers(batch, f"b{k}").view(np.uint64) + change * power(base, far - 1)
        yield pa.RecordBatch.from_arrays([batch.column("conv_id"), *(pa.array(out[c].view(np.int64)) for c in ("depth", "k1", "k2", "p1", "p2")), batch.column("conv_id"),
                                          batch.column("at"), batch.column("words"), batch.column("last")], names=_ENTRY_NAMES)


_ENTRY = "conv_id long, depth long, k1 long, k2 long, p1 long, p2 long, ref_conv long, ref_at long, words long, last boolean"
_ENTRY_NAMES = [x.split()[0] for x in _ENTRY.split(", ")]
_KEY = ["depth", "k1", "k2"]


def _beginnings(turns: Running) -> tuple[DataFrame, DataFrame]:
    """Conversations with their heads (one row each), and an entry for every
    beginning of every rebuilt one: its product, its parent's, its last turn's place and words."""
    rows = turns.select("words")
    head = F.when(F.col("at") < HEADS, F.struct("at", "a1", "a2", "b1", "b2", "words"))
    convs = rows.groupBy("conv_id").agg(F.max("at").alias("n_turns"), F.sort_array(F.collect_list(head)).alias("heads"))  # fewer than HEADS a list
    convs = _written(convs, "heads")
    own = convs.select("conv_id", "n_turns", (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS).cast("int").alias("h"),
                       (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("base"), F.col("heads").alias("own"))
    base = convs.select(F.col("conv_id").alias("base"), "heads")
    both = own.join(base, "base", "left").withColumn("n_head", F.least("h", F.greatest(F.coalesce(F.size("heads"), F.lit(0)), F.lit(0))))
    at = lambda heads, n, c: F.coalesce(F.get(heads, F.col(n) - 1)[c], F.lit(0))
    both = both.select("conv_id", "n_turns", "h", "base", "n_head", F.slice(F.coalesce("heads", F.expr("slice(own, 1, 0)")), F.lit(1), F.col("n_head")).alias("heads"),
                       at("heads", "n_head", "a1").alias("g1"), at("heads", "n_head", "a2").alias("g2"), at("own", "h", "a1").alias("o1"), at("own", "h", "a2").alias("o2"))
    both = _written(both, "conversations")
    rest = rows.join(both.select("conv_id", "n_turns", "h", "n_head", "g1", "g2", "o1", "o2"), "conv_id").where("at > h")
    rest = rest.withColumn("last", F.col("at") == F.col("n_turns")).mapInArrow(_shift, _ENTRY)
    head = both.select("conv_id", "base", (F.col("n_turns") <= F.col("h")).alias("short"), "n_head", F.inline("heads"))
    head = head.select("conv_id", F.col("at").alias("depth"), F.col("a1").alias("k1"), F.col("a2").alias("k2"), F.col("b1").alias("p1"), F.col("b2").alias("p2"),
                       F.col("base").alias("ref_conv"), F.col("at").alias("ref_at"), "words", (F.col("short") & (F.col("at") == F.col("n_head"))).alias("last"))
    zero = [F.lit(0).cast("long").alias(c) for c in ("depth", "k1", "k2", "p1", "p2", "ref_conv", "ref_at", "words")]
    root = both.select("conv_id", *zero, ((F.col("n_turns") <= F.col("h")) & (F.col("n_head") == 0)).alias("last"))
    return both, root.unionByName(head).unionByName(rest)


def _nodes(entries: DataFrame) -> DataFrame:
    parent, turn = F.struct("p1", "p2"), F.struct("ref_conv", "ref_at")
    found = entries.groupBy(*_KEY).agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("words").alias("words"), F.min(parent).alias("parent"),
                                       (F.min(parent) != F.max(parent)).alias("torn"), (F.min(turn) != F.max(turn)).alias("mixed"))
    return _written(found.select(*_KEY, "conv_id", "n_convs", "words", "parent.p1", "parent.p2", "torn", "mixed"), "nodes")


def verified(turns: Running, entries: DataFrame, nodes: DataFrame) -> bool:
    """Whether the members of every node agree in their parent and in the stored turn that they refer to."""
    if not nodes.where("torn").isEmpty():
        return False
    mixed = nodes.where("mixed").select(*_KEY)
    refs = entries.join(mixed.hint("merge"), _KEY, "left_semi").select(*_KEY, "ref_conv", "ref_at")
    texts = turns.select("role", "text").select(F.col("conv_id").alias("ref_conv"), F.col("at").alias("ref_at"), F.struct("role", "text").alias("turn"))
    meet = refs.join(texts.hint("merge"), ["ref_conv", "ref_at"]).groupBy(*_KEY).agg(F.min("turn").alias("lo"), F.max("turn").alias("hi"))
    return meet.where("lo != hi").isEmpty()


def _sums(nodes: DataFrame) -> DataFrame:
    """``nodes`` (conv_id, depth, parent_conv_id, leaf, saved) with n_leaves and saved_tokens over their subtrees."""
    first = F.min(F.struct("depth", F.col("parent_conv_id").alias("up"))).alias("first")
    runs = nodes.groupBy("conv_id").agg(F.sum("leaf").alias("leaves"), F.sum("saved").alias("tokens"), first)
    runs = _written(runs.select("conv_id", F.col("first.up").alias("up"), (F.col("first.depth") - 1).alias("hangs"), "leaves", "tokens"), "runs")
    state = runs.select("conv_id", "up", "leaves", "tokens")
    while not state.where("up is not null").isEmpty():
        below = state.where("up is not null").groupBy(F.col("up").alias("conv_id")).agg(F.sum("leaves").alias("l"), F.sum("tokens").alias("t"))
        above = state.select(F.col("conv_id").alias("up"), F.col("up").alias("upper")).where("upper is not null")
        grown = state.join(below.hint("merge"), "conv_id", "left").join(above.hint("merge"), "up", "left")
        state = _written(grown.select("conv_id", F.col("upper").alias("up"), (F.col("leaves") + F.coalesce("l", F.lit(0))).alias("leaves"),
                                      (F.col("tokens") + F.coalesce("t", F.lit(0))).alias("tokens")), "sums")
    whole = state.select("conv_id", "leaves", "tokens")
    hung = runs.select("conv_id", F.col("up"), "hangs").where("up is not null").join(whole.hint("merge"), "conv_id")
    hung = hung.groupBy(F.col("up").alias("conv_id"), F.col("hangs").alias("depth")).agg(F.sum("leaves").alias("l"), F.sum("tokens").alias("t"))
    steps = nodes.join(hung.hint("merge"), ["conv_id", "depth"], "left").select(
        *nodes.columns, (F.col("leaf") + F.coalesce("l", F.lit(0))).alias("v1"), (F.col("saved") + F.coalesce("t", F.lit(0))).alias("v2"))
    along = Running(steps, "conv_id", [F.col("depth")], ("v1", "v2"), (1, 1))
    kept = [c for c in nodes.columns if c != "conv_id"]
    return along.select(*kept).join(whole.hint("merge"), "conv_id").select(
        *nodes.columns, (F.col("leaves") - F.col("b1")).alias("n_leaves"), (F.col("tokens") - F.col("b2")).alias("saved_tokens"))


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of ids of one node, as comma-joined text."""
    for batch in batches:
        keys = [_numbers(batch, c) for c in _KEY]
        ids = _numbers(batch, "conv_id")
        new = np.ones(len(ids), dtype=bool)
        new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
        start = np.maximum.accumulate(np.where(new, np.arange(len(ids)), 0))
        cuts = np.flatnonzero((np.arange(len(ids)) - start) % PIECE == 0)
        text = list(map(str, ids.tolist()))
        joined = [",".join(text[a:b]) for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(ids)])]
        yield pa.RecordBatch.from_arrays([*(pa.array(k[cuts]) for k in keys), pa.array(ids[cuts]), pa.array(joined, pa.string())], names=[*_KEY, "first", "ids"])


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest of the pieces of each node, in order; nothing but the digest is held."""
    last, digest = None, None

    def row(found):
        return {c: v for c, v in zip(_KEY, last)} | {"ends_sha256": found.hexdigest()}

    schema = pa.schema([*((c, pa.int64()) for c in _KEY), ("ends_sha256", pa.string())])
    for batch in batches:
        done = []
        for *key, ids in zip(*(batch.column(c).to_pylist() for c in (*_KEY, "ids"))):
            if key == last:
                digest.update(b"," + ids.encode())
            else:
                if digest:
                    done.append(row(digest))
                last, digest = key, hashlib.sha256(ids.encode())
        yield pa.RecordBatch.from_pylist(done, schema)
    if digest:
        yield pa.RecordBatch.from_pylist([row(digest)], schema)


def _ends(entries: DataFrame) -> DataFrame:
    """Digest of the ids of the conversations that end at a node."""
    n = int(entries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ids = entries.where("last").select(*_KEY, "conv_id")
    pieces = ids.repartitionByRange(n, *_KEY, "conv_id").sortWithinPartitions(*_KEY, "conv_id").mapInArrow(_pieces, "depth long, k1 long, k2 long, first long, ids string")
    return pieces.repartition(n, *_KEY).sortWithinPartitions(*_KEY, "first").mapInArrow(_digest, "depth long, k1 long, k2 long, ends_sha256 string")


def conversation_trie(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens and ends_sha256 of every node of the trie of rebuilt
    conversations: the first h turns of the first conversation of the family
    (h by the id's checksum), then the own turns behind the first h.

    Turns are ordered by turn (null first), then by role and text; repeated
    rows are turns of their own. A null role or text is empty. Rows without a
    conversation are left out. An empty table has no nodes, not even the root.
    """
    read = turns.where(F.col(conv_col).isNotNull()).select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"),
                                                           F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    read = read.withColumn("words", F.size(space_words(F.col("text"))).cast("long"))
    for seed in range(SEEDS):
        hashed = read.withColumn("t1", F.xxhash64(F.lit(seed), "role", "text")).withColumn("t2", F.xxhash64("text", F.lit(~seed), "role"))
        scan = Running(hashed, "conv_id", [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")], ("t1", "t2"))
        _, entries = _beginnings(scan)
        entries = _written(entries, "entries")
        nodes = _nodes(entries)
        if verified(scan, entries, nodes):
            break
    else:
        raise RuntimeError("different beginnings share a product under every seed")
    upper = nodes.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    linked = nodes.join(upper.hint("merge"), ["depth", "p1", "p2"], "left")
    linked = _written(linked.select(*_KEY, "conv_id", "parent_conv_id", "n_convs", ((F.col("n_convs") - 1) * F.col("words")).alias("saved")), "links")
    children = linked.where("depth > 0").groupBy(F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth")).agg(F.count(F.lit(1)).alias("n_children"))
    counted = linked.join(children.hint("merge"), ["conv_id", "depth"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)).cast("long"))
    summed = _sums(counted.withColumn("leaf", (F.col("n_children") == 0).cast("long")))
    out = summed.join(_ends(entries).hint("merge"), _KEY, "left")
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(_EMPTY)).alias("ends_sha256"))


kn.ship(__name__)
