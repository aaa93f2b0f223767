"""Column helpers: safe casts, finiteness, tolerant equality, guarded division."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from pulseframe.vocab import CLOSE_TOLERANCE, EPSILON

INFINITY = float("inf")


def safe_double(col: Column) -> Column:
    """Number or null; a text that is not a number becomes null instead of failing."""
    return col.try_cast("double")


def safe_long(col: Column) -> Column:
    return col.try_cast("bigint")


def is_finite(col: Column) -> Column:
    # Spark orders NaN above every number, so one comparison rejects NaN and both infinities.
    return F.coalesce(F.abs(col) < F.lit(INFINITY), F.lit(False))


def finite(col: Column) -> Column:
    return F.when(is_finite(col), col)


def close_to(a: Column, b: Column, tolerance: float = CLOSE_TOLERANCE) -> Column:
    """Relative-or-absolute tolerant equality; false when either side is null or not finite."""
    allowed = F.greatest(F.lit(tolerance) * F.greatest(F.abs(a), F.abs(b)), F.lit(tolerance))
    return F.coalesce(F.abs(a - b) <= allowed, F.lit(False)) & is_finite(a - b)


def same_number(a: Column, b: Column) -> Column:
    """Tolerant equality that also holds between two nulls and between two equal values that are not finite."""
    return close_to(a, b) | a.eqNullSafe(b)


def guarded_ratio(numerator: Column, denominator: Column) -> Column:
    return F.when(F.abs(denominator) > F.lit(EPSILON), numerator / denominator)


def non_empty(col: Column) -> Column:
    return F.when(col != "", col)


def first_non_empty(*cols: Column) -> Column:
    return F.coalesce(*[non_empty(c) for c in cols])


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def iso_utc(clock: Column) -> Column:
    """Epoch seconds as ISO-8601 text in UTC, whatever the session time zone is."""
    utc = F.to_utc_timestamp(F.timestamp_seconds(clock), F.current_timezone())
    return F.concat(F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00"))


def parse_clock(text: Column) -> Column:
    """ISO-8601 text (with ``Z`` or an offset) to epoch seconds, null when unreadable."""
    return F.unix_timestamp(F.try_to_timestamp(text))


def floor_bucket(clock: Column, bucket_sec: int) -> Column:
    return clock - F.pmod(clock, F.lit(bucket_sec))


def ceil_bucket(clock: Column, bucket_sec: int) -> Column:
    """First grid point at or after ``clock``: the earliest trailing window that sees it."""
    return clock + F.pmod(-clock, F.lit(bucket_sec))


def tagged(pairs: list[tuple[Column, Column]]) -> Column:
    """Array of the values whose condition holds, in rule order."""
    return F.array_compact(F.array(*[F.when(cond, value) for cond, value in pairs]))


def added(cols: Sequence[Column]) -> Column:
    """Sum of whole numbers by halves: of hundreds one after another, the nesting would overflow the JVM's stack."""
    half = len(cols) // 2
    return added(cols[:half]) + added(cols[half:]) if half else cols[0]
