"""Column expressions shared by every operator.

All of them are built-in Catalyst expressions (no Python UDF), so they stay
inside whole-stage codegen.  Dictionaries become literal maps: a handful of
entries compiled into the plan, no join and no shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import schema as S


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def literal_map(mapping: Mapping) -> Column:
    """A ``map<k, v>`` literal built from a small, fixed dictionary."""
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])


def translate(c: str | Column, mapping: Mapping) -> Column:
    """Dictionary lookup with fallback to the input value (P5)."""
    c = col(c)
    return F.coalesce(literal_map(mapping)[c], c)


def is_closed(status: str | Column = "status") -> Column:
    """One closed-ticket predicate for English and Portuguese status."""
    return col(status).isin(S.CLOSED_STATUSES)


def day_period(hour: str | Column) -> Column:
    """Hour of day to period label."""
    h = col(hour)
    return (F.when((h >= 6) & (h < 12), S.PERIOD_MORNING)
            .when((h >= 12) & (h < 18), S.PERIOD_AFTERNOON)
            .when((h >= 18) & (h < 24), S.PERIOD_EVENING)
            .otherwise(S.PERIOD_NIGHT))


def weekday_index(ts: str | Column) -> Column:
    """Monday = 0 ... Sunday = 6."""
    return F.weekday(col(ts))


def weekday_name(ts: str | Column) -> Column:
    """English weekday name via a lookup on the weekday number (locale free)."""
    return F.element_at(F.array(*[F.lit(d) for d in S.WEEKDAYS_EN]), weekday_index(ts) + 1)


def duration_hours(start: str | Column, end: str | Column) -> Column:
    """Exact elapsed hours between two NTZ timestamps, sub-second part kept."""
    micros = F.timestamp_diff("MICROSECOND", col(start), col(end))
    return micros.cast("double") / F.lit(3.6e9)


def category_of(type_col: str | Column) -> Column:
    """Translated complaint type to category, default ``Outros``."""
    flat = {t: cat for cat, types in S.CATEGORY_MAPPING.items() for t in types}
    return F.coalesce(literal_map(flat)[col(type_col)], F.lit(S.DEFAULT_CATEGORY))


def resolution_bucket(days: str | Column) -> Column:
    """Days to resolution bucket 24h / 48h / 7d / 30d / 30d+."""
    d = col(days)
    expr = None
    for limit, label in S.RESOLUTION_BUCKETS:
        expr = F.when(d <= limit, label) if expr is None else expr.when(d <= limit, label)
    return expr.otherwise(S.RESOLUTION_OVERFLOW)


def pct_text(x: str | Column, digits: int = 1) -> Column:
    """Number to display text with a percent sign, e.g. ``72.5%`` (P20)."""
    return F.format_string(f"%.{digits}f%%", col(x))


def num_text(x: str | Column, digits: int = 1) -> Column:
    return F.format_string(f"%.{digits}f", col(x))


def safe_pct(num: str | Column, den: str | Column) -> Column:
    """``num * 100 / den`` as DOUBLE, NULL when den is 0."""
    return F.try_divide(col(num).cast("double") * F.lit(100.0), col(den).cast("double"))


def round_opt(c: Column, digits: int | None) -> Column:
    return c if digits is None else F.round(c, digits)
