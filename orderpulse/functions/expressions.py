"""Column expressions with explicit missing-value rules.

The analytics treat a missing comparison as "no", a zero denominator as
"unknown" and keep missing values through clipping.  Spark's own operators
differ on each point, so the rules live here once.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, functions as F, types as T

DAY_SECONDS = 86_400.0
HOUR_SECONDS = 3_600.0


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it fails or is unknown."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient that is missing when the denominator is zero or missing."""
    return numerator / F.nullif(denominator, F.lit(0).cast("double"))


def guarded_ratio(numerator: Column, denominator: Column, guard: float = 1e-9) -> Column:
    """Quotient that shifts the denominator by a small guard, so 0/0 is 0."""
    return numerator / (denominator + F.lit(guard))


def _seconds_between(start: Column, end: Column) -> Column:
    """Wall-clock seconds, untouched by clock changes of any session zone."""
    span = end.cast("timestamp_ntz") - start.cast("timestamp_ntz")
    return span.cast("interval second").cast("decimal(24,6)").cast("double")


def days_between(start: Column, end: Column) -> Column:
    """Signed fractional days from start to end."""
    return _seconds_between(start, end) / F.lit(DAY_SECONDS)


def hours_between(start: Column, end: Column) -> Column:
    return _seconds_between(start, end) / F.lit(HOUR_SECONDS)


def whole_days_between(start: Column, end: Column) -> Column:
    """Whole 24-hour days, rounded towards minus infinity (-0.5 d -> -1)."""
    return F.floor(days_between(start, end)).cast("long")


def year_month(ts: Column) -> Column:
    """Year and month as text, the same in every session time zone."""
    return F.substring(ts.cast("string"), 1, 7)


def clip(value: Column, lower, upper) -> Column:
    """Clamp to [lower, upper]; missing stays missing."""
    low = lower if isinstance(lower, Column) else F.lit(lower)
    high = upper if isinstance(upper, Column) else F.lit(upper)
    return F.when(value.isNotNull(), F.least(F.greatest(value, low), high))


def strip(text: Column) -> Column:
    """Remove leading and trailing whitespace of every kind, not just blanks."""
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def has_text(text: Column) -> Column:
    return flag(text.isNotNull() & (F.length(strip(text)) > 0))


def text_length(text: Column) -> Column:
    return F.length(strip(F.coalesce(text, F.lit("")))).cast("long")


def try_timestamp(value: Column, fmt: str | None = None) -> Column:
    """Parse a date, giving missing instead of an error on bad input.

    Dates carry no zone: spans between them never see a clock change.
    """
    if fmt:
        return F.try_to_timestamp(value, F.lit(fmt)).cast("timestamp_ntz")
    return value.try_cast("timestamp_ntz")


def try_number(value: Column, to: str = "double") -> Column:
    return value.try_cast(to)


def whole_or_zero(value: Column) -> Column:
    """Integer with missing read as 0."""
    return F.coalesce(value.try_cast("double"), F.lit(0.0)).cast("int")


def nan_to_null(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def binary_label(score: Column, threshold: float = 4) -> Column:
    return flag(score >= F.lit(threshold))


def map_values(value: Column, mapping: Mapping[str, str], default: str) -> Column:
    """Look a value up in a small fixed mapping, with a default for the rest."""
    pairs = [F.lit(x) for item in mapping.items() for x in item]
    found = F.try_element_at(F.create_map(*pairs), value) if pairs else F.lit(None).cast("string")
    return F.coalesce(found, F.lit(default))


def member_flag(value: Column, members: Iterable[str]) -> Column:
    return flag(value.isin(list(members)))


def sigmoid(score: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-score))


def safe_div(numerator: Column, denominator: Column) -> Column:
    """Quotient that is 0 when the denominator is 0 (score conventions)."""
    return F.coalesce(numerator / F.nullif(denominator.cast("double"), F.lit(0.0)), F.lit(0.0))


def count_edges_below(value: Column, edges: Iterable[float], inclusive: bool) -> Column:
    """How many of the (few) edges lie below the value; inclusive counts equality."""
    total = F.lit(0)
    for edge in edges:
        hit = value >= F.lit(float(edge)) if inclusive else value > F.lit(float(edge))
        total = total + flag(hit)
    return total


def is_numeric(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.NumericType)
