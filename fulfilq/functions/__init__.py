"""Column expressions shared by every layer (all built-in, JVM-side, codegen-friendly)."""

from fulfilq.functions.expr import (
    avg_positive_round2,
    avg_round2,
    count_where,
    date_key,
    delay_hours,
    hours_between,
    is_weekend,
    pct,
    round2_double,
    shift_of_hour,
    sla_breach,
    speed_tier,
    surrogate_key,
)

__all__ = [
    "avg_positive_round2",
    "avg_round2",
    "count_where",
    "date_key",
    "delay_hours",
    "hours_between",
    "is_weekend",
    "pct",
    "round2_double",
    "shift_of_hour",
    "sla_breach",
    "speed_tier",
    "surrogate_key",
]
