"""Dashboard marts (M1-M7): each a ``DataFrame -> DataFrame`` function.

Plan shape at scale: every mart first aggregates facts to a small grain
(day x warehouse x ...); partial aggregation runs map-side, so a warehouse or
carrier holding a third of all rows costs no more than any other. Windows
(rank, lag, rolling) run only on those aggregates or on the daily SCD2 rows,
never on raw facts. Dimension joins are broadcast (``dim_date`` is one row
per calendar day). Presentation order is left to the caller (X22);
``presentation_order`` gives the reference's ORDER BY.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fulfilq.functions import avg_positive_round2, avg_round2, count_where, pct, round2_double
from fulfilq.schemas import NEAR_CAPACITY_PCT


def _status(s: str) -> Column:
    return F.col("order_status") == s


def daily_ops_scorecard(fact_order: DataFrame, dim_date: DataFrame) -> DataFrame:
    """M1 v_daily_ops_scorecard: KPIs per day x warehouse (+ calendar attributes).

    The reference left-joins every fact row to dim_date and then groups by the
    joined attributes. Aggregating the facts to (event_date, warehouse_id) first
    and joining the calendar to the aggregate gives the same groups (day_of_week
    and is_weekend are functions of event_date) with a join over a few hundred
    rows instead of every order.
    """
    o = fact_order
    n = F.count(F.lit(1))
    agg = o.groupBy("event_date", "warehouse_id").agg(
        n.alias("total_orders"),
        F.sum("units_ordered").alias("total_units"),
        round2_double(F.sum("order_value_usd")).alias("total_revenue_usd"),
        count_where(_status("DELIVERED")).alias("delivered_orders"),
        count_where(_status("CANCELLED")).alias("cancelled_orders"),
        count_where(_status("RETURNED")).alias("returned_orders"),
        count_where(F.col("sla_breach")).alias("sla_breaches"),
        pct(count_where(_status("DELIVERED")), n).alias("delivery_rate_pct"),
        pct(count_where(F.col("sla_breach")), n).alias("sla_breach_rate_pct"),
        pct(count_where(_status("CANCELLED")), n).alias("cancellation_rate_pct"),
        avg_positive_round2("processing_hours").alias("avg_processing_hours"),
        count_where(F.col("prime_member")).alias("prime_orders"),
        count_where(~F.col("prime_member")).alias("non_prime_orders"),
    )
    d = F.broadcast(dim_date.select(F.col("full_date").alias("_d"), "day_of_week", "is_weekend"))
    joined = agg.join(d, agg["event_date"] == d["_d"], "left")
    return joined.select(
        "event_date", "warehouse_id", "day_of_week", "is_weekend", "total_orders", "total_units",
        "total_revenue_usd", "delivered_orders", "cancelled_orders", "returned_orders", "sla_breaches",
        "delivery_rate_pct", "sla_breach_rate_pct", "cancellation_rate_pct", "avg_processing_hours",
        "prime_orders", "non_prime_orders",
    )


def shift_performance(fact_order: DataFrame) -> DataFrame:
    """M2 v_shift_performance: per day x warehouse x shift, ranked by volume.

    ``avg_processing_hours`` is the unfiltered average, so the -1 fill of
    unshipped orders enters it (reference behaviour X2).
    """
    n = F.count(F.lit(1))
    agg = fact_order.groupBy("event_date", "warehouse_id", "shift").agg(
        n.alias("orders_processed"),
        F.sum("units_ordered").alias("units_processed"),
        avg_round2("processing_hours").alias("avg_processing_hours"),
        count_where(F.col("sla_breach")).alias("sla_breaches"),
        pct(count_where(F.col("sla_breach")), n).alias("sla_breach_rate_pct"),
        round2_double(F.sum("order_value_usd")).alias("shift_revenue_usd"),
    )
    w = Window.partitionBy("event_date", "warehouse_id").orderBy(F.col("orders_processed").desc())
    return agg.withColumn("shift_rank_by_volume", F.rank().over(w))


def carrier_performance(fact_shipment: DataFrame) -> DataFrame:
    """M3 v_carrier_performance: per day x carrier, with a 7-row rolling on-time rate.

    The rolling rate is a ratio of two rolling sums of the daily aggregates
    (``ROWS 6 PRECEDING``: seven rows, not seven calendar days, X16).
    """
    s = fact_shipment
    late = F.col("late_delivery")
    agg = s.groupBy("event_date", "carrier").agg(
        F.count(F.lit(1)).alias("total_shipments"),
        count_where(late).alias("late_shipments"),
        count_where(~late).alias("on_time_shipments"),
        avg_positive_round2("delivery_delay_hours").alias("avg_delay_hours"),
        round2_double(F.max("delivery_delay_hours")).alias("max_delay_hours"),
    )
    w = Window.partitionBy("carrier").orderBy(F.col("event_date").asc_nulls_last()).rowsBetween(-6, 0)
    return agg.select(
        "event_date", "carrier", "total_shipments", "late_shipments", "on_time_shipments",
        pct(F.col("on_time_shipments"), F.col("total_shipments")).alias("on_time_rate_pct"),
        "avg_delay_hours", "max_delay_hours",
        pct(F.sum("on_time_shipments").over(w), F.sum("total_shipments").over(w)).alias("rolling_7d_on_time_pct"),
    )


def orders_per_warehouse_day(fact_order: DataFrame) -> DataFrame:
    """Order count per (warehouse_id, event_date): the decorrelated scalar subquery of M4."""
    return fact_order.groupBy("warehouse_id", "event_date").agg(F.count(F.lit(1)).alias("_day_orders"))


def defect_analysis(fact_returns: DataFrame, fact_order: DataFrame) -> DataFrame:
    """M4 v_defect_analysis: incidents per day x warehouse x category x type x cause.

    ``defect_rate_pct`` divides by the number of orders of the same warehouse
    and day. The correlated ``COUNT(*)`` subquery is written as a pre-aggregate
    plus left join (Spark rejects the literal form under GROUP BY); a day with
    no orders gives NULL, like ``NULLIF(0, 0)``. Both join sides are aggregates
    (warehouses x days rows); AQE picks broadcast from their measured size.
    """
    r = fact_returns
    keys = ["event_date", "warehouse_id", "product_category", "report_type", "defect_type", "root_cause_category"]
    n = F.count(F.lit(1))
    agg = r.groupBy(*keys).agg(
        n.alias("total_incidents"),
        F.sum("units_affected").alias("total_units_affected"),
        count_where(F.col("refund_issued")).alias("refunds_issued"),
        pct(count_where(F.col("refund_issued")), n).alias("refund_rate_pct"),
    )
    per_day = orders_per_warehouse_day(fact_order)
    joined = agg.join(per_day, ["warehouse_id", "event_date"], "left")
    return joined.select(
        *keys, "total_incidents", "total_units_affected", "refunds_issued", "refund_rate_pct",
        pct(F.col("total_incidents"), F.col("_day_orders")).alias("defect_rate_pct"),
    )


def warehouse_utilization(dim_warehouse: DataFrame) -> DataFrame:
    """M5 v_warehouse_utilization: daily SCD2 rows with week-over-week and rolling measures.

    One window spec per warehouse ordered by snapshot date serves both LAG(7)
    and the 7-row rolling average (a single Window operator in the plan).
    """
    w = dim_warehouse.where(F.col("is_current") | F.col("effective_end_date").isNotNull())
    spec = Window.partitionBy("warehouse_id").orderBy(F.col("snapshot_date").asc_nulls_last())
    u = F.col("utilization_pct")
    rolling = spec.rowsBetween(-6, 0)
    return w.select(
        "snapshot_date", "warehouse_id", "warehouse_name", "region", "max_daily_capacity", "units_processed",
        u.cast("double").alias("utilization_pct"), "headcount", "active_shifts",
        (u - F.lag(u, 7).over(spec)).cast("double").alias("wow_utilization_change"),
        F.coalesce(u > NEAR_CAPACITY_PCT, F.lit(False)).alias("is_near_capacity"),
        F.round(F.sum(u).over(rolling) / F.count(u).over(rolling).cast("decimal(20,0)"), 2)
        .cast("double").alias("rolling_7d_avg_utilization"),
    )


def executive_summary(fact_order: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """M6 v_executive_summary: one row, also on empty input (counts 0, sums/rates NULL).

    The reference's "30-day" rollup has no date filter (X19); ``start``/``end``
    optionally bound ``event_date`` (pushed down to the scan as a filter).
    """
    o = fact_order
    if start is not None:
        o = o.where(F.col("event_date") >= F.lit(start).cast("date"))
    if end is not None:
        o = o.where(F.col("event_date") <= F.lit(end).cast("date"))
    n = F.count(F.lit(1))
    return o.agg(
        F.min("event_date").alias("period_start"),
        F.max("event_date").alias("period_end"),
        n.alias("total_orders"),
        F.sum("units_ordered").alias("total_units"),
        round2_double(F.sum("order_value_usd")).alias("total_revenue_usd"),
        avg_round2("order_value_usd").alias("avg_order_value_usd"),
        pct(count_where(_status("DELIVERED")), n).alias("overall_delivery_rate_pct"),
        pct(count_where(F.col("sla_breach")), n).alias("overall_sla_breach_rate_pct"),
        pct(count_where(_status("CANCELLED")), n).alias("overall_cancellation_rate_pct"),
        pct(count_where(_status("RETURNED")), n).alias("overall_return_rate_pct"),
        avg_positive_round2("processing_hours").alias("avg_processing_hours"),
        count_where(F.col("prime_member")).alias("prime_orders"),
        pct(count_where(F.col("prime_member")), n).alias("prime_order_pct"),
    )


def table_row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """M7: (table_name, row_count) per table, one UNION ALL of global counts."""
    parts = [df.select(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count"))
             for name, df in sorted(tables.items())]
    return reduce(DataFrame.unionByName, parts)


def order_status_mix(orders: DataFrame) -> DataFrame:
    """Orders per status and their share of all orders (percent, 2 digits).

    The total is the sum of the counts already made: one row, so the input is
    scanned once and raw text with many distinct statuses never meets in one task.
    """
    counts = orders.groupBy("order_status").agg(F.count(F.lit(1)).alias("orders")).withColumn("_one", F.lit(1))
    total = counts.agg(F.sum("orders").alias("_total"), F.lit(1).alias("_one"))
    j = counts.join(total, "_one")
    return j.select("order_status", "orders", pct(F.col("orders"), F.col("_total")).alias("share_pct"))


# The reference views' ORDER BY: (column, descending). NULLs first when descending,
# last when ascending, as in the reference warehouse.
PRESENTATION_ORDER = {
    "daily_ops_scorecard": [("event_date", True), ("warehouse_id", False)],
    "shift_performance": [("event_date", True), ("warehouse_id", False), ("shift", False)],
    "carrier_performance": [("event_date", True), ("on_time_rate_pct", False)],
    "defect_analysis": [("event_date", True), ("total_incidents", True)],
    "warehouse_utilization": [("snapshot_date", True), ("warehouse_id", False)],
}


def presentation_columns(mart: str) -> list[Column]:
    return [F.col(c).desc_nulls_first() if desc else F.col(c).asc_nulls_last() for c, desc in PRESENTATION_ORDER[mart]]


def presentation_order(df: DataFrame, mart: str) -> DataFrame:
    """Sort a mart for presentation (a global sort: use on mart-sized results only)."""
    return df.orderBy(*presentation_columns(mart))
