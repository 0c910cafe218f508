"""Scalar column functions.

Each function takes and returns ``Column`` objects built from
``pyspark.sql.functions`` so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from functools import reduce
from typing import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from farelake import fixed

__all__ = [
    "col_of", "year_of", "month_of", "hour_of", "day_of_month", "day_name",
    "day_of_week", "is_weekend", "to_date", "date_key", "duration_minutes",
    "duration_floor0", "wait_minutes", "season_north", "season_index",
    "season_label", "miles_to_km", "revenue_per_hour", "code_label",
    "translate_label", "upper_text", "lower_text", "trim_text", "normalize_id",
    "join_text", "round_to", "conditional", "month_abbr",
]


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def year_of(ts) -> Column:
    return F.year(col_of(ts))


def month_of(ts) -> Column:
    return F.month(col_of(ts))


def hour_of(ts) -> Column:
    return F.hour(col_of(ts))


def day_of_month(ts) -> Column:
    return F.dayofmonth(col_of(ts))


def day_name(ts) -> Column:
    """Full English weekday name ('Monday'); ``dayname`` would give 'Mon'."""
    return F.date_format(col_of(ts), "EEEE")


def day_of_week(ts) -> Column:
    """1 = Sunday ... 7 = Saturday."""
    return F.dayofweek(col_of(ts))


def is_weekend(ts) -> Column:
    return F.dayofweek(col_of(ts)).isin(1, 7)


def to_date(ts) -> Column:
    return F.to_date(col_of(ts))


def date_key(ts, fmt: str = "yyyyMMdd") -> Column:
    """Integer date key; ``ddMMyyyy`` drops a leading zero (1012024)."""
    return F.date_format(col_of(ts), fmt).cast("int")


def duration_minutes(start, end) -> Column:
    """(end - start) in minutes as double; works for timestamp and timestamp_ntz."""
    return F.timestamp_diff("MICROSECOND", col_of(start), col_of(end)) / F.lit(60_000_000.0)


def duration_floor0(start, end) -> Column:
    """Duration in minutes, 0 when negative; null stays null."""
    d = duration_minutes(start, end)
    return F.when(d < 0, F.lit(0.0)).otherwise(d)


def wait_minutes(request, event) -> Column:
    """Minutes from request to an event (pickup, on scene), floored at 0."""
    return duration_floor0(request, event)


def season_north(month) -> Column:
    """Winter/Spring/Summer/Fall by month number; null month -> null."""
    m = col_of(month)
    winter, spring, summer, fall = fixed.SEASON_NORTH
    return (F.when((m == 12) | (m <= 2), winter)
            .when(m <= 5, spring)
            .when(m <= 8, summer)
            .when(m <= 11, fall))


def season_index(month) -> Column:
    """``month % 12 // 3 + 1``: 1 = Dec-Feb, 2 = Mar-May, 3 = Jun-Aug, 4 = Sep-Nov."""
    m = col_of(month)
    return (F.pmod(m, F.lit(12)) / 3).cast("int") + 1


def season_label(month, labels: Mapping[int, str] = fixed.SEASON_INDEX_PT) -> Column:
    return translate_label(season_index(month), labels)


def month_abbr(month, labels: Mapping[int, str] = fixed.MONTH_ABBR_PT) -> Column:
    return translate_label(month, labels)


def miles_to_km(miles, factor: float = fixed.MILES_TO_KM, digits: int | None = None) -> Column:
    km = col_of(miles) * F.lit(factor)
    return F.round(km, digits) if digits is not None else km


def revenue_per_hour(total, minutes) -> Column:
    """total / (minutes / 60); null when minutes is 0 (no ANSI error)."""
    return F.try_divide(col_of(total), col_of(minutes) / F.lit(60.0))


def code_label(code, labels: Mapping, default: str | None = None) -> Column:
    """Map a code to text through a literal map; unmapped codes -> ``default``.

    Codes are compared as numbers when the map keys are numbers.
    """
    c = col_of(code)
    expr = None
    for k, v in labels.items():
        expr = F.when(c == F.lit(k), F.lit(v)) if expr is None else expr.when(c == F.lit(k), F.lit(v))
    if expr is None:
        return F.lit(default)
    return expr.otherwise(F.lit(default))


def translate_label(value, mapping: Mapping) -> Column:
    """Literal-map lookup; unmapped -> null."""
    pairs = []
    for k, v in mapping.items():
        pairs += [F.lit(k), F.lit(v)]
    return F.element_at(F.create_map(*pairs), col_of(value)) if pairs else F.lit(None)


def upper_text(c) -> Column:
    return F.upper(col_of(c))


def lower_text(c) -> Column:
    return F.lower(col_of(c))


def trim_text(c) -> Column:
    return F.trim(col_of(c))


def normalize_id(c) -> Column:
    return F.trim(F.lower(col_of(c)))


def join_text(sep: str, *cols) -> Column:
    """Null-skipping text join (``concat_ws``)."""
    return F.concat_ws(sep, *[col_of(c) for c in cols])


def round_to(c, digits: int) -> Column:
    return F.round(col_of(c), digits)


def conditional(cond: Column, a, b) -> Column:
    def lit_or_col(x):
        return x if isinstance(x, Column) else F.lit(x)
    return F.when(cond, lit_or_col(a)).otherwise(lit_or_col(b))


def all_of(preds) -> Column | None:
    preds = [p for p in preds if p is not None]
    return reduce(lambda a, b: a & b, preds) if preds else None
