"""Quality rules: a decision list learned by sequential covering.

``text_statistics`` counts simple facts of a text with SQL functions only.
``learn`` grows conjunctions of thresholds on ratios of those counts from a
bounded sample of labelled rows: a rule takes the condition of highest
information gain until it covers no good text of the growing part, then drops
trailing conditions while that helps on the pruning part; covered rows leave
and the next rule is grown. ``as_columns`` emits the ordered list as one Spark
conditional expression, so applying it is a projection without shuffle.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.columns import SPACES, gram_hashes, space_words

#: Labelled rows that ``learn`` may read.
SAMPLE_ROWS = 20_000
WINDOW = 8

#: Ratio name -> (numerator, denominator) over the counts of ``text_statistics``.
RATIOS = {
    "chars_per_word": ("word_chars", "n_words"),
    "symbols_per_word": ("n_symbols", "n_words"),
    "marks_per_word": ("n_marks", "n_words"),
    "capitals_per_char": ("n_capitals", "word_chars"),
    "digits_per_char": ("n_digits", "word_chars"),
    "repeated_lines": ("n_dup_lines", "n_lines"),
    "repeated_words": ("n_repeat_words", "n_words"),
    "words_per_line": ("n_words", "n_lines"),
}


def text_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    n_lines, n_marks, n_capitals, n_digits (all long), and the columns named in ``keep``.

    A null text counts as empty: all zero. Repeated rows are counted each by
    itself. Window repeats inside a text are found by sorting its window
    hashes, so a very long text costs n log n. The counts come out of a
    generator: a caller's filter on them stays above it. Pushed below, it would
    be rewritten in terms of the text, and every step above computed again for
    every window.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = docs.select(F.col(id_col).alias("doc_id"), *keep, text.alias("_text"))
    # Steps below are used more than once, so each is a projection of its own.
    base = base.withColumn("_words", space_words(F.col("_text")))
    base = base.withColumn("_lines", F.filter(F.split("_text", "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != ""))
    base = base.withColumn("_grams", gram_hashes(F.col("_words"), WINDOW))
    again = F.size(F.array_distinct("_grams")) < F.size("_grams")
    order = F.when(again, F.sort_array(F.transform("_grams", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    base = base.withColumn("_order", order)
    s = F.col("_order")
    same = F.filter(s, lambda e, j: ((j > 0) & F.coalesce(F.get(s, j - 1)["h"] == e["h"], F.lit(False)))
                    | F.coalesce(F.get(s, j + 1)["h"] == e["h"], F.lit(False)))
    at = F.sort_array(F.transform(same, lambda e: e["i"]))
    start = F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last"))
    inside = F.aggregate(at, start, lambda a, i: F.struct((a["n"] + F.least(F.lit(WINDOW), i - a["last"])).alias("n"), i.alias("last")),
                         lambda a: a["n"])
    count = lambda keep_class: F.length(F.regexp_replace("_text", f"[^{keep_class}]+", ""))
    counts = [
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        count("#*$%&|<>").cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(inside, F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size("_lines").cast("long").alias("n_lines"), count("!?").cast("long").alias("n_marks"),
        count("A-Z").cast("long").alias("n_capitals"), count("0-9").cast("long").alias("n_digits")]
    return base.select("doc_id", *keep, F.inline(F.array(F.struct(*counts))))


def ratio(name: str) -> Column:
    top, bottom = RATIOS[name]
    return F.when(F.col(bottom) > 0, F.col(top) / F.col(bottom)).otherwise(F.lit(0.0))


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def holds(self, value: float) -> bool:
        return value > self.threshold if self.above else value <= self.threshold

    def column(self) -> Column:
        return ratio(self.feature) > self.threshold if self.above else ratio(self.feature) <= self.threshold


Rule = tuple[Condition, ...]


def _covers(rule: Rule, row: dict) -> bool:
    return all(c.holds(row[c.feature]) for c in rule)


def _best_condition(rows: list[tuple[dict, bool]], features: list[str]) -> tuple[float, Condition | None]:
    """Condition of highest gain for the bad rows; scans each feature once in order."""
    bad, total = sum(b for _, b in rows), len(rows)
    before = math.log2(bad / total)
    best: tuple[float, Condition | None] = (0.0, None)
    for name in features:
        values = sorted((r[name], b) for r, b in rows)
        seen = seen_bad = 0
        for i, (v, b) in enumerate(values[:-1]):
            seen, seen_bad = seen + 1, seen_bad + b
            after = values[i + 1][0]
            if after <= v:
                continue
            middle = (v + after) / 2
            for above, n, p in ((False, seen, seen_bad), (True, total - seen, bad - seen_bad)):
                if p and (gain := p * (math.log2(p / n) - before)) > best[0] + 1e-9:
                    best = (gain, Condition(name, above, middle))
    return best


def learn(rows: list[tuple[dict, bool]], purity: float = 0.97, least: int = 5, most_rules: int = 16,
          most_conditions: int = 4) -> list[Rule]:
    """Ordered rules that name bad rows. ``rows``: ratios and whether the row is bad.

    Every third row prunes and judges. A rule stays if on those rows, too, at
    least ``purity`` of what it covers is bad, and it covers ``least`` bad rows
    in all; learning ends with the first that does not.
    """
    grow = [x for i, x in enumerate(rows) if i % 3]
    prune = [x for i, x in enumerate(rows) if not i % 3]
    rules: list[Rule] = []
    while len(rules) < most_rules and any(b for _, b in grow):
        rule: Rule = ()
        left = grow
        while len(rule) < most_conditions and not all(b for _, b in left):
            _, condition = _best_condition(left, list(RATIOS))
            if condition is None:
                break
            rule += (condition,)
            left = [x for x in left if condition.holds(x[0][condition.feature])]

        def worth(r: Rule) -> float:
            got = [b for v, b in prune if _covers(r, v)]
            return (2 * sum(got) - len(got)) / len(got) if got else -1.0

        if not rule:
            break
        while len(rule) > 1 and worth(rule[:-1]) >= worth(rule):
            rule = rule[:-1]
        got = [b for v, b in grow + prune if _covers(rule, v)]
        judged = [b for v, b in prune if _covers(rule, v)]
        if sum(got) < least or sum(got) < purity * len(got) or sum(judged) < purity * len(judged):
            break
        rules.append(rule)
        grow = [x for x in grow if not _covers(rule, x[0])]
        prune = [x for x in prune if not _covers(rule, x[0])]
    return rules


def labelled_rows(docs: DataFrame, labels: DataFrame, label_col: str = "quality", sample_rows: int = SAMPLE_ROWS) -> list[tuple[dict, bool]]:
    """Ratios of at most ``sample_rows`` labelled documents (lowest id hash first).

    Ids labelled more than once count once, as bad only if every label is 0;
    null ids and null labels are left out.
    """
    picked = (labels.where(F.col("doc_id").isNotNull() & F.col(label_col).isNotNull())
              .groupBy("doc_id").agg(F.max(label_col).alias("_label"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows))
    own = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")  # at most sample_rows rows
    stats = text_statistics(own, keep=("_label",)).select("doc_id", "_label", *(ratio(n).alias(n) for n in RATIOS))
    found = stats.distinct().collect()
    found.sort(key=lambda r: tuple(r))
    return [({n: r[n] for n in RATIOS}, r["_label"] == 0) for r in found]


def base_failed() -> Column:
    """Fixed rule: under 20 words, or over 30 % of the words in repeated windows."""
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def rule_number(rules: list[Rule]) -> Column:
    """Number of the first rule that covers the row, counted from 1; null if none does."""
    out = F.lit(None).cast("int")
    for i in range(len(rules), 0, -1):
        test = F.lit(True)
        for c in rules[i - 1]:
            test = test & c.column()
        out = F.when(test, F.lit(i)).otherwise(out)
    return out


def judge_quality(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Counts of ``text_statistics``, base_failed, bad_rule (number of the
    learned rule that rejects the text, else null) and kept, one row per input row.

    Without labelled rows, or with labels of one kind only, no rule is learned
    and base_failed alone decides. Null and empty texts have no words and fail.
    """
    rules = learn(labelled_rows(docs, labels, sample_rows=sample_rows))
    stats = text_statistics(docs).withColumn("base_failed", base_failed()).withColumn("bad_rule", rule_number(rules))
    return stats.withColumn("kept", ~F.col("base_failed") & F.col("bad_rule").isNull())
