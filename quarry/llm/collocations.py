"""Phrase collocations, mined by partitioning (SON).

The corpus is mined shard by shard: a shard is a run of a partition's rows of
about ``SHARD_BYTES`` of text, so it fits into a task's memory. A phrase that
reaches ``min_count`` over the corpus reaches, in at least one shard, that
count lowered in proportion to the shard's part of its language; so a shard
reports all phrases that reach its lowered (local) support, with their counts.
The union of the reports, added up, bounds every phrase's count from above once
the local supports that some shards may have stayed under are added; phrases
that cannot reach ``min_count`` go. This is done for one, two and three words
in turn, and longer phrases are mined only where both shorter ones passed. A
last pass counts the phrases that are left exactly, as texts.

What passed is known to the tasks by a table of ``2**TABLE_BITS`` bits, whatever
the corpus. A phrase that shares its bit with another is counted for nothing
and dropped by its exact count, so no result depends on the table or on hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm import kernels as kn
from quarry.session import scratch_path

#: Text of a shard, words of a step within it (its word numbers fit 21 bits), bits of the table of what passed.
SHARD_BYTES = 2_000_000
STEP_WORDS = 1 << 20
TABLE_BITS = 26
#: Languages whose local supports are raised with a shard's part of them; in all others one occurrence is enough for a report.
MOST_LANGS = 256

BREAK = kn.byte_class(b".,;:!?\n\x0b\x0c\r")
SEPARATOR = BREAK | kn.byte_class(b" \t")
#: Rows of a batch that goes back to Spark.
BATCH_ROWS = 1 << 16
_REPORT = "key long, n long, spare int"
_COUNT = "lang string, words int, phrase string, n long"
Totals = dict[str, int]


def shards(batches: Iterator[pa.RecordBatch], sizes) -> Iterator[list[pa.RecordBatch]]:
    """Rows of a partition in runs that begin every ``SHARD_BYTES``; ``sizes`` gives the bytes of a batch's rows."""
    held: list[pa.RecordBatch] = []
    at = current = 0
    for batch in batches:
        own = sizes(batch)
        number = (at + np.cumsum(own) - own) // SHARD_BYTES
        at += int(own.sum())
        cuts = [0, *(np.flatnonzero(np.diff(number)) + 1).tolist(), batch.num_rows] if batch.num_rows else [0]
        for a, b in zip(cuts, cuts[1:]):
            if held and number[a] != current:
                yield held
                held = []
            current = int(number[a])
            held.append(batch.slice(a, b - a))
    if held:
        yield held


def _lengths(column: str):
    return lambda batch: batch.column(column).to_numpy(zero_copy_only=False).astype(np.int64)


def _text_sizes(batch: pa.RecordBatch) -> np.ndarray:
    return pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def local_supports(langs: list[str], sizes: np.ndarray, totals: Totals, min_count: int) -> dict[str, int]:
    """``min_count`` lowered to a shard's part of each language (rounded up), from the bytes of its rows."""
    own: dict[str, int] = {}
    for lang, size in zip(langs, sizes.tolist()):
        own[lang] = own.get(lang, 0) + size
    return {lang: max(1, -(-min_count * n // totals[lang])) if totals.get(lang) else 1 for lang, n in own.items()}


def _unreported(totals: Totals, min_count: int):
    """What stays under the local supports: per shard and language, if any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for parts in shards(batches, _lengths("size")):
            table = pa.Table.from_batches(parts)
            support = local_supports(table.column("lang").to_pylist(), table.column("size").to_numpy(), totals, min_count)
            less = {lang: t - 1 for lang, t in support.items() if t > 1}
            yield pa.RecordBatch.from_pydict({"lang": pa.array(list(less), pa.string()), "less": pa.array(less.values(), pa.int64())})

    return run


class Words:
    """Words of some rows: numbers of the distinct (language, word) pairs,
    their hashes, and whether a word is followed by one of the same piece."""

    def __init__(self, data: np.ndarray, lengths: np.ndarray, lang: np.ndarray, joined: np.ndarray, lang_keys: np.ndarray, powers: kn.Powers):
        offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
        column = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])
        coded = column.dictionary_encode()
        self.texts, n = coded.dictionary, len(coded.dictionary)
        pairs, self.ids = np.unique(lang.astype(np.int64) * max(n, 1) + coded.indices.to_numpy(), return_inverse=True)
        self.word, self.lang = pairs % max(n, 1), pairs // max(n, 1)
        buf, off = kn.text_buffer(self.texts)
        hashes = kn.word_hashes(buf, off[:-1], off[1:], powers)
        self.keys = kn.mix(hashes[self.word] ^ lang_keys[self.lang])
        self.joined = joined

    def phrases(self, n: int, passed: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """For one, two, three words in turn (as far as ``passed`` goes, and
        one more): word numbers, counts, keys and languages of the distinct
        phrases that start in the first ``n`` words and whose shorter parts passed."""
        size = max(len(self.keys), 1)
        yield np.arange(len(self.keys))[:, None], np.bincount(self.ids[:n], minlength=len(self.keys)), self.keys, self.lang
        if not passed:
            return
        ok = holds(passed[0], self.keys)[self.ids]
        at = np.flatnonzero(self.joined[:-1] & ok[:-1] & ok[1:])
        codes, place = np.unique(self.ids[at] * size + self.ids[at + 1], return_inverse=True)
        parts = np.stack([codes // size, codes % size], 1)
        keys = kn.mix(self.keys[parts[:, 0]] * np.uint64(kn.BASE_B) + self.keys[parts[:, 1]])
        yield parts, np.bincount(place[at < n], minlength=len(codes)), keys, self.lang[parts[:, 0]]
        if len(passed) < 2:
            return
        pair = np.full(len(self.ids) + 1, -1, dtype=np.int64)
        good = holds(passed[1], keys)[place]
        pair[at[good]] = place[good]
        first = np.flatnonzero((pair[:-2] >= 0) & (pair[1:-1] >= 0))
        first = first[first < n]
        codes, counts = np.unique(pair[first] * size + self.ids[first + 2], return_counts=True)
        two, third = codes // size, codes % size
        yield np.concatenate([parts[two], third[:, None]], 1), counts, kn.mix(keys[two] * np.uint64(kn.BASE_B) + self.keys[third]), self.lang[third]


def holds(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether the bits of the keys are set."""
    cell = keys & np.uint64(len(table) * 64 - 1)
    return (table[(cell >> np.uint64(6)).astype(np.int64)] >> (cell & np.uint64(63)) & np.uint64(1)).astype(bool)


def _lang_key(lang: str) -> int:
    return int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little")


def _steps(parts: list[pa.RecordBatch], powers: kn.Powers) -> Iterator[tuple[Words, int, list[str], bool]]:
    """The words of a shard in steps: words, how many of them phrases start
    with (two more follow), language names, whether this is the whole shard."""
    names: dict[str, int] = {}
    data, lengths, langs, joined = [], [], [], []
    for part in (x for p in parts for x in kn.slices(p, "text")):
        code = np.array([names.setdefault(x, len(names)) for x in part.column("lang").to_pylist()], dtype=np.int64)
        buf, off = kn.text_buffer(part.column("text"))
        starts, ends, rows = kn.word_spans(buf, off, SEPARATOR)
        row = np.repeat(np.arange(len(rows) - 1), np.diff(rows))
        piece = np.cumsum(BREAK[buf])[starts] if len(starts) else starts
        data.append(kn.LOWER[buf[~SEPARATOR[buf]]])
        lengths.append(ends - starts)
        langs.append(code[row])
        joined.append(np.append((row[1:] == row[:-1]) & (piece[1:] == piece[:-1]), False)[: len(starts)])
    data, lengths, langs, joined = (np.concatenate(x) for x in (data, lengths, langs, joined))
    keys = np.array([_lang_key(x) for x in names], dtype=np.uint64)
    ends = np.concatenate([[0], np.cumsum(lengths)])
    for a in range(0, len(lengths), STEP_WORDS):
        b = min(len(lengths), a + STEP_WORDS + 2)
        follows = joined[a:b].copy()
        follows[-1] = False  # a phrase that would go on is counted in no step's first words
        yield Words(data[ends[a]: ends[b]], lengths[a:b], langs[a:b], follows, keys, powers), min(STEP_WORDS, b - a), list(names), len(lengths) <= STEP_WORDS


def _mine(totals: Totals, spare: Totals, min_count: int, passed: list[np.ndarray]):
    """Reports of the phrases of ``len(passed) + 1`` words: key, count over the
    local support's last missing one, and what other shards may have left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = kn.Powers()
        for parts in shards(batches, _text_sizes):
            langs = [x for p in parts for x in p.column("lang").to_pylist()]
            support = local_supports(langs, np.concatenate([_text_sizes(p) for p in parts]), totals, min_count)
            for words, n, names, whole in _steps(parts, powers):
                least = np.array([support[x] if whole else 1 for x in names], dtype=np.int64)
                *_, (_, counts, keys, lang) = words.phrases(n, passed)
                at = np.flatnonzero((counts >= least[lang]) & (counts > 0))
                rest = np.array([spare.get(x, 0) for x in names], dtype=np.int32)
                found = pa.RecordBatch.from_pydict({"key": keys[at].view(np.int64), "n": counts[at] - least[lang[at]] + 1, "spare": rest[lang[at]]})
                yield from _cut(found)

    return run


def _count(passed: list[np.ndarray]):
    """Counts of the phrases that passed, as texts, and of all words (no phrase)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = kn.Powers()
        for parts in shards(batches, _text_sizes):
            for words, n, names, _ in _steps(parts, powers):
                lang = pa.array(names, pa.string())
                total = np.bincount(words.lang[words.ids[:n]], minlength=len(names))
                yield _counted(lang, 0, pa.nulls(len(names), pa.string()), total)
                text = words.texts.cast(pa.binary()).cast(pa.string())
                for k, (numbers, counts, keys, own) in enumerate(words.phrases(n, passed[:2])):
                    at = np.flatnonzero(holds(passed[k], keys) & (counts > 0))
                    each = [text.take(pa.array(words.word[numbers[at, j]])) for j in range(k + 1)]
                    yield from _cut(_counted(lang.take(pa.array(own[at])), k + 1, pc.binary_join_element_wise(*each, " "), counts[at]))

    return run


def _cut(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch in smaller ones; Arrow's unused memory goes back to the system,
    as a worker lives through many shards."""
    for a in range(0, batch.num_rows, BATCH_ROWS):
        yield batch.slice(a, BATCH_ROWS)
    pa.default_memory_pool().release_unused()


def _counted(lang: pa.Array, words: int, phrase: pa.Array, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([lang, pa.array(np.full(len(n), words, dtype=np.int32)), phrase, pa.array(n.astype(np.int64))], names=["lang", "words", "phrase", "n"])


def _passed(reports: DataFrame, min_count: int, bits: int) -> np.ndarray:
    """Table of the bits of the keys whose count may reach ``min_count``. The
    driver receives its words that are not zero (``2**bits / 64`` at most)."""
    may = reports.groupBy("key").agg(F.sum("n").alias("n"), F.max("spare").alias("spare")).where(F.col("n") + F.col("spare") >= min_count)
    cell = may.select(F.col("key").bitwiseAND(F.lit((1 << bits) - 1)).alias("cell"))
    words = cell.groupBy(F.shiftright("cell", 6).alias("at")).agg(F.bit_or(F.expr("shiftleft(1L, cast(cell & 63 as int))")).alias("word")).toArrow()
    table = np.zeros((1 << bits) // 64, dtype=np.uint64)
    table[words.column("at").to_numpy()] = words.column("word").to_numpy().view(np.uint64)
    return table


def phrase_counts(docs: DataFrame, min_count: int = 10, lang_col: str = "lang", text_col: str = "text", bits: int = TABLE_BITS) -> DataFrame:
    """lang, words (1 to 3), phrase and n for every phrase that occurs
    ``min_count`` times or more in its language, and a row without words and
    phrase with the number of all words of each language.

    Texts are lower-cased in A-Z, cut at ``. , ; : ! ?`` and line ends, and
    split at spaces and tabs; a phrase is a run of words within a cut. A null
    text is empty, a null language ``und``; every row counts, repeats too.
    ``docs`` is read several times and has to give the same partitions each
    time, as a stored table does.
    """
    lang = F.coalesce(F.col(lang_col), F.lit("und")).alias("lang")
    slim = docs.select(lang, F.coalesce(F.octet_length(text_col), F.lit(0)).alias("size"))
    texts = docs.select(lang, F.col(text_col).alias("text"))
    largest = slim.groupBy("lang").agg(F.sum("size").alias("size")).orderBy(F.desc("size"), "lang").limit(MOST_LANGS)
    totals = {r["lang"]: r["size"] for r in largest.collect()}
    less = slim.mapInArrow(_unreported(totals, min_count), "lang string, less long").groupBy("lang").agg(F.sum("less").alias("less"))
    spare = {r["lang"]: r["less"] for r in less.collect()}  # of at most MOST_LANGS languages
    passed: list[np.ndarray] = []
    for _ in range(3):
        reports = texts.mapInArrow(_mine(totals, spare, min_count, passed), _REPORT)
        passed = [*passed, _passed(reports, min_count, bits)]
    counts = texts.mapInArrow(_count(passed), _COUNT).groupBy("lang", "words", "phrase").agg(F.sum("n").alias("n"))
    return counts.where((F.col("n") >= min_count) | F.col("phrase").isNull())


def _lasting(counts: DataFrame) -> DataFrame:
    path = scratch_path(counts.sparkSession, "phrases")
    counts.write.parquet(path)
    return counts.sparkSession.read.schema(counts.schema).parquet(path)


def _wide(column: str):
    return F.col(column).cast("decimal(14,0)")  # counts under 10**14: products stay within 38 digits


def collocations(docs: DataFrame, min_count: int = 10, percent: int = 50, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """lang, phrase (two or three words), a (its count), l and r (those of the
    parts at its weakest cut), n (words of the language) and score
    (floor(10**6 a a / (l r)), exact) of every phrase of ``min_count``
    occurrences that no longer one with ``percent`` % of them contains.

    Of cuts with equal scores the first counts. Nulls, repeats and the cuts of
    texts are those of ``phrase_counts``; an empty table gives none.
    """
    counts = _lasting(phrase_counts(docs, min_count, lang_col, text_col))
    several = counts.where("words > 1").select("lang", "words", "phrase", F.col("n").alias("a"))
    part = counts.where("words between 1 and 2").select("lang", F.col("phrase").alias("part"), F.col("n").alias("f"))
    cuts = several.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    first = F.expr("substring_index(phrase, ' ', k)")
    cuts = cuts.withColumn("first", first).withColumn("rest", F.expr("substr(phrase, length(first) + 2)"))
    cuts = cuts.join(part.select("lang", F.col("part").alias("first"), F.col("f").alias("l")), ["lang", "first"])
    cuts = cuts.join(part.select("lang", F.col("part").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
    cuts = cuts.withColumn("_top", _wide("a") * _wide("a") * F.lit(1_000_000).cast("decimal(8,0)")).withColumn("_bottom", _wide("l") * _wide("r"))
    weakest = F.min(F.struct(F.expr("_top div _bottom").alias("score"), "k", "l", "r"))
    scored = cuts.groupBy("lang", "phrase", "a").agg(weakest.alias("cut")).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    ends = F.array(F.expr("substring_index(phrase, ' ', 2)"), F.expr("substring_index(phrase, ' ', -2)"))
    inside = several.where("words = 3").select("lang", F.explode(ends).alias("phrase"), F.col("a").alias("_longer")).groupBy("lang", "phrase").agg(F.max("_longer").alias("_longer"))
    whole = counts.where(F.col("phrase").isNull()).select("lang", "n")
    left = scored.join(inside, ["lang", "phrase"], "left").where(F.col("_longer").isNull() | (100 * F.col("_longer") < percent * F.col("a")))
    return left.join(whole, "lang").select("lang", "phrase", "a", "l", "r", "n", "score")


def top_collocations(found: DataFrame, most: int = 2000) -> DataFrame:
    """The first ``most`` of each language by score, count (both descending) and phrase, with their rank from 1."""
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


kn.ship(__name__)
