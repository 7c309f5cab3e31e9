"""Column expressions shared by the operators that stay on the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACES = " \t\n\u000b\f\r"


def space_words(text: Column) -> Column:
    """Maximal runs without ASCII white space; none for null."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[\x20\x09-\x0D]+"))


#: ASCII characters that are neither letters nor digits.
MARKS = "".join(chr(c) for c in range(128) if not chr(c).isalnum())


def token_words(text: Column) -> Column:
    """Runs of ASCII letters (lower-cased), digits and non-ASCII characters; none for null."""
    text = F.coalesce(text, F.lit(""))
    low = F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(
        F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    trimmed = F.btrim(low, F.lit(MARKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"))


def gram_hashes(words: Column, k: int) -> Column:
    """Hash of every run of k words, by start; none if there are fewer."""
    return F.when(F.size(words) >= k, F.transform(F.sequence(F.lit(1), F.size(words) - (k - 1)),
                                                  lambda i: F.xxhash64(F.slice(words, i, k)))
                  ).otherwise(F.array().cast("array<bigint>"))
