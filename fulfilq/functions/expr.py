"""Scalar and aggregate column helpers.

Money, hours and percentages are computed in DECIMAL and rounded half-up
(away from zero) exactly; only the final presented value is cast to DOUBLE.
Rounding a binary double at two digits is not exact (1.005 is stored as
1.00499...), and averaging a DECIMAL first rounds the quotient to six digits,
so both are avoided: averages are ``sum / count`` in wide decimal.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F



def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def count_where(pred: Column) -> Column:
    """``SUM(CASE WHEN p THEN 1 ELSE 0 END)``: 0 on a non-empty group, NULL on empty input."""
    return F.sum(F.when(pred, F.lit(1)).otherwise(F.lit(0)))


def pct(numerator: Column, denominator: Column, digits: int = 2) -> Column:
    """``ROUND(100.0 * n / NULLIF(d, 0), digits)`` as DOUBLE; exact half-up rounding."""
    n = numerator.cast("decimal(20,0)")
    d = F.nullif(denominator.cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)"))
    return F.round(F.lit(100).cast("decimal(3,0)") * n / d, digits).cast("double")


def avg_round2(x: str | Column) -> Column:
    """``ROUND(AVG(x), 2)`` for a DECIMAL column, exact, as DOUBLE (NULL on no values)."""
    x = _col(x)
    return F.round(F.sum(x) / F.count(x).cast("decimal(20,0)"), 2).cast("double")


def avg_positive_round2(x: str | Column) -> Column:
    """``ROUND(AVG(CASE WHEN x > 0 THEN x END), 2)``: sentinel and zero values excluded."""
    x = _col(x)
    return avg_round2(F.when(x > 0, x))


def round2_double(x: Column) -> Column:
    """``ROUND(x, 2)`` of a DECIMAL expression, presented as DOUBLE."""
    return F.round(x, 2).cast("double")


def hours_between(later: str | Column, earlier: str | Column) -> Column:
    """(later - earlier) in hours, rounded half-up to 2 digits, DECIMAL; NULL if either is NULL."""
    secs = (F.unix_timestamp(_col(later)) - F.unix_timestamp(_col(earlier))).cast("decimal(20,0)")
    return F.round(secs / F.lit(3600).cast("decimal(4,0)"), 2)


def delay_hours(actual: str | Column, estimated: str | Column) -> Column:
    """Delivery delay in hours (positive = late) as DOUBLE; NULL unless both times exist."""
    a, e = _col(actual), _col(estimated)
    return F.when(a.isNotNull() & e.isNotNull(), hours_between(a, e).cast("double"))


def speed_tier(hours: str | Column) -> Column:
    """Fast (<= 12 h), Standard (<= 24 h), Slow (> 24 h), else Unknown."""
    h = _col(hours)
    return (
        F.when(h <= 12, F.lit("Fast"))
        .when(h <= 24, F.lit("Standard"))
        .when(h > 24, F.lit("Slow"))
        .otherwise(F.lit("Unknown"))
    )


def shift_of_hour(ts: str | Column) -> Column:
    """Morning 06-13, Afternoon 14-21, otherwise Night (by the hour of ``ts``)."""
    h = F.hour(_col(ts))
    return F.when(h.between(6, 13), F.lit("Morning")).when(h.between(14, 21), F.lit("Afternoon")).otherwise(
        F.lit("Night")
    )


def sla_breach(placed_at: str | Column, shipped_at: str | Column, sla_hours: str | Column) -> Column:
    """Never shipped -> breach; else time to ship strictly above the category SLA (exact seconds)."""
    shipped, placed = _col(shipped_at), _col(placed_at)
    secs = F.unix_timestamp(shipped) - F.unix_timestamp(placed)
    return F.when(shipped.isNull(), F.lit(True)).otherwise(secs > _col(sla_hours) * 3600)


def is_weekend(d: str | Column) -> Column:
    """Saturday or Sunday (Spark ``dayofweek``: Sunday = 1, Saturday = 7)."""
    return F.dayofweek(_col(d)).isin(1, 7)


def date_key(d: str | Column) -> Column:
    """YYYYMMDD integer key of a date."""
    d = _col(d)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def surrogate_key(*business_key: str | Column) -> Column:
    """Deterministic 64-bit surrogate key from the business key (stable across reloads).

    A convenience key like the reference's identity column: every join, dedup
    and upsert in this library uses the business key, because 64-bit hashes
    of ~10^10 distinct keys are expected to collide somewhere.
    """
    return F.xxhash64(*[_col(c) for c in business_key])
