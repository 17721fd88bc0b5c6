import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from fulfilq.operators import dims, marts
from fulfilq.plans.star import fixture_star

D = dt.date
FACT_ORDER = ("order_id string, warehouse_id string, order_status string, shift string, units_ordered int, "
              "order_value_usd decimal(10,2), prime_member boolean, sla_breach boolean, "
              "processing_hours decimal(8,2), event_date date")


def _order(oid, day=D(2024, 1, 1), wh="W1", status="DELIVERED", shift="Morning", units=1, value="10.00",
           prime=True, breach=False, hours="5.00"):
    return (oid, wh, status, shift, units, Decimal(value), prime, breach,
            None if hours is None else Decimal(hours), day)


def test_shift_rank_ties_share_rank(spark):
    rows = [_order("a", shift="Morning"), _order("b", shift="Afternoon"), _order("c", shift="Night"),
            _order("d", shift="Night"), _order("e", day=D(2024, 1, 2), shift="Morning")]
    out = {(r.event_date, r.shift): r.shift_rank_by_volume
           for r in marts.shift_performance(spark.createDataFrame(rows, FACT_ORDER)).collect()}
    assert out[(D(2024, 1, 1), "Night")] == 1
    assert out[(D(2024, 1, 1), "Morning")] == 2 and out[(D(2024, 1, 1), "Afternoon")] == 2
    assert out[(D(2024, 1, 2), "Morning")] == 1


def test_m2_uses_unfiltered_average(spark):
    rows = [_order("a", hours="-1.00", status="CANCELLED"), _order("b", hours="3.00")]
    r = marts.shift_performance(spark.createDataFrame(rows, FACT_ORDER)).first()
    assert r.avg_processing_hours == 1.0  # (-1 + 3) / 2: the -1 fill enters the M2 average


def test_rolling_rate_with_short_history_and_missing_day(spark):
    schema = "shipment_id string, carrier string, late_delivery boolean, delivery_delay_hours decimal(8,2), event_date date"
    rows = []
    for i, day in enumerate([1, 2, 4]):  # Jan 3 missing: the 7-row frame is rows, not days
        rows += [(f"s{i}a", "UPS", False, Decimal("-1.00"), D(2024, 1, day)),
                 (f"s{i}b", "UPS", i == 2, Decimal("2.50") if i == 2 else None, D(2024, 1, day))]
    out = {r.event_date: r for r in marts.carrier_performance(spark.createDataFrame(rows, schema)).collect()}
    assert out[D(2024, 1, 1)].rolling_7d_on_time_pct == 100.0
    assert out[D(2024, 1, 4)].rolling_7d_on_time_pct == 83.33   # 5 on time of 6 over 3 rows
    assert out[D(2024, 1, 4)].avg_delay_hours == 2.5 and out[D(2024, 1, 4)].max_delay_hours == 2.5


def test_defect_rate_null_without_orders(spark):
    rs = "record_id string, event_date date, warehouse_id string, product_category string, report_type string, " \
         "defect_type string, root_cause_category string, units_affected int, refund_issued boolean"
    returns = spark.createDataFrame([
        ("r1", D(2024, 1, 1), "W1", "Books", "RETURN", "Wrong item", "Carrier", 1, True),
        ("r2", D(2024, 1, 9), "W1", "Books", "DEFECT", "Wrong item", "Carrier", 2, False),
    ], rs)
    orders = spark.createDataFrame([_order("a"), _order("b"), _order("c"), _order("d")], FACT_ORDER)
    out = {r.event_date: r for r in marts.defect_analysis(returns, orders).collect()}
    assert out[D(2024, 1, 1)].defect_rate_pct == 25.0 and out[D(2024, 1, 1)].refund_rate_pct == 100.0
    assert out[D(2024, 1, 9)].defect_rate_pct is None


def test_executive_summary_on_empty_input(spark):
    r = marts.executive_summary(spark.createDataFrame([], FACT_ORDER)).collect()
    assert len(r) == 1
    r = r[0]
    assert r.total_orders == 0 and r.prime_orders is None and r.total_revenue_usd is None
    assert r.overall_delivery_rate_pct is None and r.period_start is None


def test_scorecard_joins_calendar(spark):
    rows = [_order("a", day=D(2024, 1, 6)), _order("b", day=D(2024, 1, 6), prime=False, status="CANCELLED")]
    r = marts.daily_ops_scorecard(spark.createDataFrame(rows, FACT_ORDER), dims.dim_date(spark)).first()
    assert r.day_of_week == "Saturday" and r.is_weekend is True
    assert (r.total_orders, r.prime_orders, r.non_prime_orders, r.cancelled_orders) == (2, 1, 1, 1)
    assert r.delivery_rate_pct == 50.0 and r.total_revenue_usd == 20.0


def test_dim_date_rows_and_attributes(spark):
    d = dims.dim_date(spark)
    assert d.count() == 1461
    r = d.where(F.col("full_date") == F.lit("2024-01-07").cast("date")).first()
    assert (r.date_sk, r.day_of_week, r.day_of_week_num, r.is_weekend, r.is_weekday) == (20240107, "Sunday", 1, True, False)
    assert r.month_name == "January" and r.quarter == 1 and r.week_of_year == 1


def test_invariants_on_fixture(spark):
    t = fixture_star(spark, "/root/testdata/sf0.001")
    m1 = marts.daily_ops_scorecard(t["fact_order"], t["dim_date"])
    m2 = marts.shift_performance(t["fact_order"])
    m6 = marts.executive_summary(t["fact_order"]).first()
    s1 = m1.agg(F.sum("total_orders"), F.sum("total_units"), F.sum("sla_breaches")).first()
    s2 = m2.agg(F.sum("orders_processed"), F.sum("units_processed"), F.sum("sla_breaches")).first()
    assert tuple(s1) == tuple(s2)                              # shifts add up to the daily totals
    assert (s1[0], s1[1]) == (m6.total_orders, m6.total_units)  # days add up to the summary
    per_day = m1.groupBy("event_date").agg(F.sum("total_orders").alias("n"))
    assert per_day.agg(F.sum("n")).first()[0] == m6.total_orders


def test_presentation_order(spark):
    rows = [_order("a", day=D(2024, 1, 1), wh="W2"), _order("b", day=D(2024, 1, 2), wh="W1"),
            _order("c", day=D(2024, 1, 1), wh="W1")]
    m1 = marts.daily_ops_scorecard(spark.createDataFrame(rows, FACT_ORDER), dims.dim_date(spark))
    got = [(r.event_date.day, r.warehouse_id) for r in marts.presentation_order(m1, "daily_ops_scorecard").collect()]
    assert got == [(2, "W1"), (1, "W1"), (1, "W2")]
