import datetime as dt

from fulfilq.operators import quality

D = dt.date
ORD = ("order_id string, warehouse_id string, order_status string, placed_at timestamp, shipped_at timestamp, "
       "delivered_at timestamp, units_ordered int, order_value_usd double, sla_breach boolean, event_date date")
T = dt.datetime(2024, 1, 1, 8)


def _res(df):
    return {r.check_id: r for r in df.collect()}


def test_order_checks_count_violations_with_null_semantics(spark):
    rows = [
        ("o1", "W1", "DELIVERED", T, T, T, 1, 5.0, True, D(2024, 1, 1)),
        ("o1", "W1", "DELIVERED", T, None, None, 0, None, False, D(2024, 1, 30)),  # dup id, no ship ts, bad units/value
        ("o3", None, "BOGUS", T, None, None, 2, 3.0, None, D(2024, 1, 2)),
        ("o4", "W1", None, None, None, None, 1, 1.0, False, D(2024, 1, 2)),
    ]
    r = _res(quality.quality_orders(spark.createDataFrame(rows, ORD)))
    assert r["Q1"].passed is False and r["Q1"].observed == 4.0
    assert r["Q2"].violations == 1
    assert r["Q4"].violations == 1 and r["Q5"].violations == 1 and r["Q6"].violations == 1
    assert r["Q7"].violations == 2           # unknown status and NULL status both fail
    assert r["Q8"].violations == 1 and r["Q9"].violations == 1
    assert r["Q10"].observed == 1 / 3 and r["Q10"].severity == "warn"   # NULL breach skipped in the mean
    assert r["Q13"].violations == 1 and r["Q14"].violations == 1
    assert r["Q15"].observed == 29.0 and r["Q15"].passed is True


def test_referential_checks(spark):
    orders = spark.createDataFrame([
        ("o1", "W1", "SHIPPED", T, T, None, 1, 1.0, False, D(2024, 1, 1)),
        ("o2", "W1", "CANCELLED", T, None, None, 1, 1.0, True, D(2024, 1, 1)),
        ("o3", "W1", "RETURNED", T, T, T, 1, 1.0, False, D(2024, 1, 1)),
    ], ORD)
    ships = spark.createDataFrame([("s1", "o1", "UPS", "1Z", False), ("s2", "o2", "UPS", "1Z", True),
                                   ("s3", None, None, "1Z", False)],
                                  "shipment_id string, order_id string, carrier string, tracking_number string, "
                                  "late_delivery boolean")
    r = _res(quality.quality_shipments(ships, orders))
    assert r["Q20"].violations == 2          # cancelled order and NULL order id are orphans
    assert r["Q21"].violations == 1          # o3 shipped without shipment (warn)
    assert r["Q18"].violations == 1 and r["Q22"].observed == 1 / 3
    rets = spark.createDataFrame([("r1", "o3", "RETURN", 1), ("r2", "o1", "RETURN", 0), ("r3", "o1", "OTHER", 1)],
                                 "record_id string, order_id string, report_type string, units_affected int")
    rr = _res(quality.quality_returns(rets, orders))
    assert rr["Q32"].violations == 1 and rr["Q30"].violations == 1 and rr["Q31"].violations == 1


def test_capacity_checks(spark):
    cap = spark.createDataFrame([("W1", D(2024, 1, 1), 101.0, 10, 5, 0), ("W9", D(2024, 1, 2), 50.0, 1, 5, 3)],
                                "warehouse_id string, snapshot_date date, utilization_pct double, "
                                "units_processed int, max_daily_capacity int, headcount int")
    exp = spark.createDataFrame([("W1",), ("W2",)], "warehouse_id string")
    r = _res(quality.quality_capacity(cap, exp))
    assert r["Q23"].violations == 2 and r["Q23"].passed is False   # W9 unexpected, W2 missing
    assert r["Q24"].violations == 1 and r["Q25"].violations == 1 and r["Q26"].violations == 1
    assert r["Q27"].observed == 1.0 and r["Q27"].passed is False
