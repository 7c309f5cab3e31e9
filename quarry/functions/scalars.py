"""Column expressions (JVM-side, inside whole-stage codegen).

Every function takes and returns ``Column`` objects, so it composes into any
``select``/``where``/``agg`` and stays visible to Catalyst.
"""

from __future__ import annotations


from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the observed job's formats.
# Decimal pattern for percentages: one decimal, half-even, no leading zero.
PCT_PATTERN = "#.0"
# Date text layout of an observation: two-digit year, day, month, dot separated.
DATE_TEXT_FORMAT = "yy.dd.MM"
# Separators of the growth report line: "<market>;  <item>,  <pct>%".
GROWTH_SEP_1 = ";  "
GROWTH_SEP_2 = ",  "

LONG_MAX = 9223372036854775807


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _date_pieces(text: Column | str) -> Column:
    """Dot-separated pieces; empty ones at the end do not count."""
    return F.split(F.rtrim(_c(text), F.lit(".")), r"\.", -1)


def date_key(text: Column | str) -> Column:
    """``yy.dd.MM`` text -> int ``yyMMdd`` for ordering; NULL unless the text
    is well formed and its pieces together are a number. An empty piece before
    the last adds no digits (``17..11`` -> 1711)."""
    parts = _date_pieces(text)
    key = F.concat(F.get(parts, 0), F.get(parts, 2), F.get(parts, 1))
    return F.when(is_well_formed_date(text), parse_long(key).try_cast("int"))


def is_well_formed_date(text: Column | str) -> Column:
    """True when the date text has exactly three dot pieces (rows failing this
    are skipped by the growth job)."""
    return F.size(_date_pieces(text)) == 3


def parse_long(text: Column | str) -> Column:
    """Strict decimal integer text -> bigint; anything else (spaces, decimals,
    out of range, empty) -> NULL instead of a failed job."""
    s = _c(text)
    return F.when(s.rlike(r"^[+-]?[0-9]+$"), s.try_cast("bigint"))


def growth_pct(early: Column | str, late: Column | str, zero_base: str = "null") -> Column:
    """``(late - early) / early * 100`` in double.

    ``zero_base='null'`` gives NULL when ``early`` is 0; ``'infinite'`` keeps
    the unbounded growth of a zero start (+inf for late > 0, NULL for 0 -> 0).
    """
    e = _c(early).cast("double")
    l_ = _c(late).cast("double")
    pct = F.try_divide(l_ - e, e) * F.lit(100.0)
    if zero_base == "null":
        return pct
    if zero_base == "infinite":
        inf = F.lit(float("inf"))
        return (F.when(e != 0, pct)
                .when(l_ > 0, inf)
                .when(l_ < 0, -inf))
    raise ValueError(f"zero_base must be 'null' or 'infinite', got {zero_base!r}")


def trunc_long(x: Column | str) -> Column:
    """Truncate a double toward zero to bigint; +/-inf saturate, NaN -> 0,
    NULL stays NULL (no ANSI overflow error)."""
    v = _c(x)
    return (F.when(v.isNull(), F.lit(None).cast("bigint"))
            .when(F.isnan(v), F.lit(0).cast("bigint"))
            .when(v >= F.lit(float(LONG_MAX)), F.lit(LONG_MAX).cast("bigint"))
            .when(v <= F.lit(-float(LONG_MAX)), F.lit(-LONG_MAX - 1).cast("bigint"))
            .otherwise(v.cast("bigint")))


def format_pct(x: Column | str) -> Column:
    """Decimal pattern ``#.0``: one decimal, half-even, no leading zero."""
    return F.call_function("format_number", _c(x), F.lit(PCT_PATTERN))


def overlap_line(count_m1: Column | str, pct: Column | str, market2: str) -> Column:
    """``total <count as double>; <pct>% in <market2>``."""
    return F.concat(F.lit("total "), _c(count_m1).cast("double").cast("string"), F.lit("; "),
                    format_pct(pct), F.lit("% in "), F.lit(market2))


def growth_line(market: Column | str, item: Column | str, pct: Column | str) -> Column:
    """``<market>;  <item>,  <pct>%``."""
    return F.concat(_c(market).cast("string"), F.lit(GROWTH_SEP_1), _c(item).cast("string"),
                    F.lit(GROWTH_SEP_2), format_pct(pct), F.lit("%"))


def squared_distance(a: Column | str, b: Column | str) -> Column:
    """Sum of squared element differences of two numeric arrays, in double,
    summed left to right."""
    diffs = F.zip_with(_c(a), _c(b), lambda x, y: (x.cast("double") - y.cast("double"))
                       * (x.cast("double") - y.cast("double")))
    return F.aggregate(diffs, F.lit(0.0), lambda acc, d: acc + d)


def to_int(x: Column | str) -> Column:
    """Prediction (double) -> int label."""
    return _c(x).cast("int")


