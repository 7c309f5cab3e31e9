"""URL filters: pattern rules indexed by their rarest literal token.

A rule has a regular expression over ``host + path`` and the literal tokens
(maximal runs of ASCII letters and digits) that every matching URL must hold as
whole tokens. The rule is filed under the one of them that is rarest among the
URLs; a URL's own tokens then fetch the few rules worth trying, and only those
run their expression. One pass over the rows; no shuffle. The rule list is a
parameter of fixed size and travels with the task.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm import kernels as kn

TOKEN = "[A-Za-z0-9]+"
_UPPER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


@dataclass(frozen=True)
class Rule:
    """``name`` is reported; of several matching rules the highest ``rank`` wins,
    then the first listed."""

    name: str
    verdict: str
    pattern: str
    tokens: tuple[str, ...]
    rank: int


def site_rule(name: str, verdict: str) -> Rule:
    """Rule ``host/path-prefix``: the host or any of its subdomains, and a path
    that starts with what follows the host. Longer rules rank higher."""
    host, slash, rest = name.partition("/")
    path = slash + rest
    whole = "/".join(path.split("/")[:-1])  # the last segment may go on in the URL
    return Rule(name, verdict, rf"(?:[^/]*\.)?{re.escape(host)}{re.escape(path)}",
                tuple(dict.fromkeys(re.findall(TOKEN, host + whole))), len(name))


def word_rule(word: str, verdict: str) -> Rule:
    """Rule for a word among the dot- or hyphen-separated parts of the host."""
    return Rule(f"*{word}*", verdict, rf"(?:[^/]*[.-])?{re.escape(word)}(?:[.-][^/]*)?(?:/|\Z)", (word,), 0)


#: Host words that the default list blocks where no site rule fits.
BLOCKED_HOST_WORDS = ("adult", "casino", "malware", "phishing", "porn", "spam", "torrent", "warez", "xxx")


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path; both empty without ``://``."""
    _, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    host = re.match(r"[^/?#]*", rest)[0]
    return host.translate(_UPPER), re.match(r"[^?#]*", rest[len(host):])[0]


def build_index(rules: list[Rule], counts: dict[str, int]) -> tuple[dict[str, list[int]], list[int]]:
    """Rules by their rarest token, and those without any token."""
    index: dict[str, list[int]] = {}
    always = []
    for i, rule in enumerate(rules):
        if rule.tokens:
            index.setdefault(min(rule.tokens, key=lambda t: (counts.get(t, 0), t)), []).append(i)
        else:
            always.append(i)
    return index, always


def candidates(host: str, path: str, index: dict[str, list[int]], always: list[int]) -> list[int]:
    """Rules fetched by the tokens of a URL, in list order."""
    found = set(always)
    for token in set(re.findall(TOKEN, host + path)):
        found.update(index.get(token, ()))
    return sorted(found)


def token_counts(pages: DataFrame, rules: list[Rule], url_col: str = "url") -> dict[str, int]:
    """How many URLs hold each token of the rules (as many rows as such tokens)."""
    wanted = sorted({t for r in rules for t in r.tokens})
    if not wanted:
        return {}
    tokens = F.array_distinct(F.split(F.coalesce(F.col(url_col), F.lit("")), "[^A-Za-z0-9]+"))
    held = F.array_intersect(tokens, F.array(*map(F.lit, wanted)))
    return {r["t"]: r["n"] for r in pages.select(F.explode(held).alias("t")).groupBy("t").agg(F.count("*").alias("n")).collect()}


def _judge(rules: list[Rule], index, always, otherwise: str, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = [re.compile(r.pattern) for r in rules]
        for batch in batches:
            hosts, paths, names, verdicts, tried = [], [], [], [], []
            for url in batch.column("url").to_pylist():
                host, path = split_url(url)
                look = candidates(host, path, index, always) if host or path else []
                hits = [i for i in look if compiled[i].match(host + path)]
                best = max(hits, key=lambda i: (rules[i].rank, -i), default=None)
                hosts.append(host)
                paths.append(path)
                names.append(None if best is None else rules[best].name)
                verdicts.append(otherwise if best is None else rules[best].verdict)
                tried.append(len(look))
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), pa.array(hosts, pa.string()), pa.array(paths, pa.string()),
                                              pa.array(names, pa.string()), pa.array(verdicts, pa.string()),
                                              pa.array(tried, pa.int64())], schema=schema)

    return run


def judge_urls(pages: DataFrame, rules: list[Rule], otherwise: str = "allow", id_col: str = "page_id",
               url_col: str = "url") -> DataFrame:
    """page_id, host, path, matched_rule, verdict, n_tried (expressions run).

    A null URL or one without ``://`` has empty host and path, matches no rule
    and gets ``otherwise``. Every row is judged by itself: repeated rows and
    null ids stay, an empty table stays empty.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    index, always = build_index(rules, token_counts(pages, rules, url_col))
    schema = T.StructType([T.StructField("page_id", pages.schema[id_col].dataType), T.StructField("host", T.StringType()),
                           T.StructField("path", T.StringType()), T.StructField("matched_rule", T.StringType()),
                           T.StructField("verdict", T.StringType()), T.StructField("n_tried", T.LongType())])
    source = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"))
    return source.mapInArrow(_judge(rules, index, always, otherwise, to_arrow_schema(schema)), schema)


kn.ship(__name__)
