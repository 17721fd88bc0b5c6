"""Oracle SQL (DuckDB dialect) for every registered query.

The fixture mapping is restated here as SQL over the driver's tables, so the
oracle never runs our Spark code. Rounding is written as exact integer
arithmetic (half away from zero), because DuckDB turns every DECIMAL division
into DOUBLE; the Spark side rounds in DECIMAL. Both present DOUBLE.
"""

from __future__ import annotations

# Fixed values, restated here so that a wrong constant of the library shows.
PRODUCT_CATEGORY_SLA_HOURS = [
    ("Electronics", 24), ("Books", 48), ("Apparel", 36), ("Home & Kitchen", 48), ("Sports", 48),
    ("Toys", 36), ("Beauty", 24), ("Grocery", 12), ("Tools", 48), ("Pet Supplies", 36),
]
CARRIERS = [
    ("UPS", "National"), ("FedEx", "National"), ("USPS", "National"), ("Amazon Logistics", "Internal"),
    ("OnTrac", "Regional"),
]
DEFECT_TYPES = ["Damaged in transit", "Wrong item", "Missing item", "Late delivery", "Packaging defect"]
ROOT_CAUSES = ["Carrier", "Warehouse", "Supplier", "Customer error"]
FIXTURE_REGIONS = ["North", "Central", "Coast", "North", "Central", "Coast"]
FIXTURE_CAPACITY = [3600, 4250, 4900, 5550, 6200, 6850]


def _list(values) -> str:
    return "[" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values) + "]"


CATS = _list([c for c, _ in PRODUCT_CATEGORY_SLA_HOURS])
SLAS = _list([h for _, h in PRODUCT_CATEGORY_SLA_HOURS])
CARRIER_NAMES = _list([c for c, _ in CARRIERS])
DEFECTS = _list(DEFECT_TYPES)
CAUSES = _list(ROOT_CAUSES)
REGIONS = _list(FIXTURE_REGIONS)
CAPS = _list(FIXTURE_CAPACITY)
CAT_ROWS = ", ".join(f"('{c}', {h})" for c, h in PRODUCT_CATEGORY_SLA_HOURS)
CARRIER_ROWS = ", ".join(f"('{c}', '{t}')" for c, t in CARRIERS)


def pct_sql(n: str, d: str) -> str:
    """ROUND(100 * n / NULLIF(d, 0), 2) for non-negative counts, exact, as DOUBLE."""
    return (f"(CASE WHEN ({d}) = 0 THEN NULL ELSE "
            f"CAST((20000 * CAST({n} AS HUGEINT) + ({d})) // (2 * ({d})) AS DOUBLE) / 100 END)")


def ratio2_sql(cents: str, n: str) -> str:
    """ROUND(cents / n / 100, 2) half away from zero, as DOUBLE (cents integral)."""
    return (f"(CASE WHEN ({n}) = 0 THEN NULL ELSE CAST(sign({cents}) * ((2 * abs({cents}) + ({n})) "
            f"// (2 * ({n}))) AS DOUBLE) / 100 END)")


def avg2_sql(x: str, over: str = "") -> str:
    """ROUND(AVG(x), 2) of a 2-digit DECIMAL, exact, as DOUBLE."""
    cents = f"CAST(SUM({x}) {over} * 100 AS HUGEINT)"
    return ratio2_sql(cents, f"COUNT({x}) {over}")


def hundredths(x: str) -> str:
    """Integer count of hundredths -> DECIMAL(18,2)."""
    return f"(CAST({x} AS DECIMAL(18,0)) * CAST(0.01 AS DECIMAL(3,2)))"


def fold_date(ts: str) -> str:
    return f"(DATE '2024-01-01' + CAST(date_diff('day', DATE '1995-01-01', CAST({ts} AS DATE)) % 30 AS INTEGER))"


FIXTURES = f"""
fx_o0 AS (
  SELECT o_orderkey AS _k, o_custkey AS _c, o_orderstatus AS _os, o_totalprice AS _tp,
         {fold_date('o_orderdate')} AS event_date,
         150 + (o_orderkey * 37 + o_custkey * 11) % 3000 AS _ship_min,
         (o_orderkey + o_custkey) % 10 AS _cat
  FROM orders),
fx_o1 AS (
  SELECT *,
         CASE WHEN _k % 100 < 3 THEN 'CANCELLED' WHEN _k % 100 < 8 THEN 'RETURNED'
              WHEN _os = 'P' THEN 'SHIPPED' ELSE 'DELIVERED' END AS order_status,
         CAST(event_date AS TIMESTAMP) + to_minutes(CAST((_k * 7) % 1440 AS BIGINT)) AS placed_at
  FROM fx_o0),
fx_o2 AS (
  SELECT *, CASE WHEN order_status <> 'CANCELLED'
                 THEN placed_at + to_minutes(CAST(_ship_min AS BIGINT)) END AS shipped_at
  FROM fx_o1),
fx_order_events_k AS (
  SELECT _k,
         printf('ORD-%07d', _k) AS order_id,
         'FC_0' || CAST(_c % 6 AS VARCHAR) AS warehouse_id,
         ({CATS})[_cat + 1] AS product_category,
         order_status, placed_at, shipped_at,
         CASE WHEN order_status IN ('DELIVERED', 'RETURNED')
              THEN shipped_at + to_minutes(CAST(1080 + (_k * 53) % 3240 AS BIGINT)) END AS delivered_at,
         CASE WHEN hour(placed_at) BETWEEN 6 AND 13 THEN 'Morning'
              WHEN hour(placed_at) BETWEEN 14 AND 21 THEN 'Afternoon' ELSE 'Night' END AS shift,
         CAST(1 + _k % 8 AS INTEGER) AS units_ordered,
         CAST(_tp AS DECIMAL(10,2)) AS order_value_usd,
         _c % 2 = 0 AS prime_member,
         (order_status = 'CANCELLED' OR _ship_min > 60 * ({SLAS})[_cat + 1]) AS sla_breach,
         CASE WHEN order_status <> 'CANCELLED'
              THEN CAST({hundredths('(_ship_min * 200 + 60) // 120')} AS DECIMAL(8,2)) END AS processing_hours,
         event_date
  FROM fx_o2),
fx_order_events AS (SELECT * EXCLUDE (_k) FROM fx_order_events_k),
fx_order_events_dirty AS (
  SELECT * FROM fx_order_events
  UNION ALL
  SELECT order_id, warehouse_id, product_category, order_status, placed_at - INTERVAL 1 HOUR, shipped_at,
         delivered_at, shift, 0, order_value_usd, prime_member, sla_breach, processing_hours, event_date
  FROM fx_order_events_k WHERE _k % 50 = 0
  UNION ALL
  SELECT 'BAD-' || CAST(_k AS VARCHAR), warehouse_id, product_category, NULL, placed_at, shipped_at,
         delivered_at, shift, units_ordered, order_value_usd, prime_member, sla_breach, processing_hours, event_date
  FROM fx_order_events_k WHERE _k % 997 = 0),
fx_s0 AS (
  SELECT l.l_orderkey, l.l_partkey AS _p, l.l_suppkey AS _s, l.l_linenumber, l.l_returnflag, o.o_custkey,
         {fold_date('l.l_shipdate')} AS event_date,
         CASE WHEN l.l_linestatus = 'O' AND l.l_partkey % 10 = 0 THEN NULL
              WHEN (l.l_partkey + l.l_suppkey) % 12 = 0 THEN 120 + l.l_partkey % 2760
              ELSE -(60 + l.l_partkey % 660) END AS _delay_min
  FROM lineitem l LEFT JOIN orders o ON o.o_orderkey = l.l_orderkey),
fx_s1 AS (
  SELECT *, CAST(event_date AS TIMESTAMP) + to_minutes(CAST(_p % 1440 AS BIGINT)) AS shipped_at FROM fx_s0),
fx_s2 AS (
  SELECT *, shipped_at + to_minutes(CAST(1200 + (_p % 61) * 60 AS BIGINT)) AS estimated_delivery_at FROM fx_s1),
fx_shipment_tracking AS (
  SELECT printf('SHP-%07d', l_orderkey) || '-' || CAST(l_linenumber AS VARCHAR) AS shipment_id,
         printf('ORD-%07d', l_orderkey) AS order_id,
         'FC_0' || CAST(o_custkey % 6 AS VARCHAR) AS warehouse_id,
         ({CARRIER_NAMES})[_s % 5 + 1] AS carrier,
         printf('1Z%09d', _p) AS tracking_number,
         shipped_at, estimated_delivery_at,
         estimated_delivery_at + to_minutes(CAST(_delay_min AS BIGINT)) AS actual_delivery_at,
         CASE WHEN l_returnflag = 'R' THEN 'RETURNED' WHEN _delay_min IS NULL THEN 'SHIPPED'
              ELSE 'DELIVERED' END AS delivery_status,
         COALESCE(_delay_min > 0, FALSE) AS late_delivery,
         event_date
  FROM fx_s2),
fx_shipments_dirty AS (
  SELECT * FROM fx_shipment_tracking
  UNION ALL
  SELECT * REPLACE (CAST(NULL AS VARCHAR) AS order_id, shipped_at + INTERVAL 1 HOUR AS shipped_at)
  FROM fx_shipment_tracking WHERE CAST(substr(tracking_number, 3) AS BIGINT) % 97 = 0
  UNION ALL
  SELECT * REPLACE ('BAD-' || shipment_id AS shipment_id, CAST(NULL AS VARCHAR) AS tracking_number,
                    CAST(NULL AS BOOLEAN) AS late_delivery)
  FROM fx_shipment_tracking WHERE CAST(substr(tracking_number, 3) AS BIGINT) % 101 = 0),
fx_cap0 AS (
  SELECT warehouse_id, event_date, COUNT(*) AS _n, CAST(substr(warehouse_id, 5, 1) AS INTEGER) AS _i,
         5500 + (COUNT(*) * 137) % 4400 AS _bp
  FROM fx_order_events GROUP BY warehouse_id, event_date),
fx_warehouse_capacity AS (
  SELECT event_date AS snapshot_date, warehouse_id,
         'Fulfillment center ' || CAST(_i AS VARCHAR) AS warehouse_name,
         ({REGIONS})[_i + 1] AS region,
         CAST(({CAPS})[_i + 1] AS INTEGER) AS max_daily_capacity,
         CAST((({CAPS})[_i + 1] * _bp) // 10000 AS INTEGER) AS units_processed,
         CAST({hundredths('_bp')} AS DECIMAL(5,2)) AS utilization_pct,
         CAST(2 + _n % 2 AS INTEGER) AS active_shifts,
         CAST(180 + (_n * 7) % 341 AS INTEGER) AS headcount
  FROM fx_cap0),
fx_returns_defects AS (
  SELECT printf('RD-%07d', _k) AS record_id, order_id, warehouse_id, product_category,
         CASE WHEN order_status = 'RETURNED' THEN 'RETURN' ELSE 'DEFECT' END AS report_type,
         ({DEFECTS})[(_k // 100) % 5 + 1] AS defect_type,
         delivered_at + to_days(CAST(1 + _k % 14 AS INTEGER)) AS reported_at,
         CAST(1 + _k % units_ordered AS INTEGER) AS units_affected,
         (order_status = 'RETURNED' OR (_k // 25) % 5 < 3) AS refund_issued,
         ({CAUSES})[(_k // 100) % 4 + 1] AS root_cause_category,
         event_date
  FROM fx_order_events_k
  WHERE order_status = 'RETURNED' OR (order_status = 'DELIVERED' AND _k % 25 = 0)),
fx_returns_dirty AS (
  SELECT * FROM fx_returns_defects
  UNION ALL
  SELECT * REPLACE (reported_at - INTERVAL 1 DAY AS reported_at, CAST(0 AS INTEGER) AS units_affected)
  FROM fx_returns_defects WHERE CAST(substr(record_id, 4) AS BIGINT) % 3 = 0
  UNION ALL
  SELECT * REPLACE ('BAD-' || record_id AS record_id, CAST(NULL AS VARCHAR) AS report_type)
  FROM fx_returns_defects WHERE CAST(substr(record_id, 4) AS BIGINT) % 7 = 0
  UNION ALL
  SELECT * REPLACE (record_id || '-R' AS record_id, 'RETURN' AS report_type)
  FROM fx_returns_defects WHERE report_type = 'DEFECT' AND CAST(substr(record_id, 4) AS BIGINT) % 50 = 0),
curated_orders AS (
  SELECT order_id, warehouse_id, product_category, order_status, placed_at, shipped_at, delivered_at, shift,
         units_ordered, CAST(order_value_usd AS DOUBLE) AS order_value_usd, prime_member, sla_breach,
         CAST(COALESCE(processing_hours, -1) AS DOUBLE) AS processing_hours, event_date,
         dayname(placed_at) AS order_day_of_week,
         dayofweek(placed_at) IN (0, 6) AS is_weekend,
         CASE WHEN COALESCE(processing_hours, -1) <= 12 THEN 'Fast'
              WHEN COALESCE(processing_hours, -1) <= 24 THEN 'Standard'
              WHEN COALESCE(processing_hours, -1) > 24 THEN 'Slow' ELSE 'Unknown' END AS fulfillment_speed_tier
  FROM fx_order_events),
fact_order AS (
  SELECT * REPLACE (CAST(order_value_usd AS DECIMAL(10,2)) AS order_value_usd,
                    CAST(processing_hours AS DECIMAL(8,2)) AS processing_hours)
  FROM curated_orders),
shipments_ranked AS (
  SELECT *, ROW_NUMBER() OVER (
           PARTITION BY shipment_id
           ORDER BY shipped_at DESC NULLS LAST, order_id DESC NULLS LAST, warehouse_id DESC NULLS LAST,
                    carrier DESC NULLS LAST, tracking_number DESC NULLS LAST,
                    estimated_delivery_at DESC NULLS LAST, actual_delivery_at DESC NULLS LAST,
                    delivery_status DESC NULLS LAST, late_delivery DESC NULLS LAST,
                    event_date DESC NULLS LAST) AS _rn
  FROM fx_shipments_dirty),
dedup_shipments AS (SELECT * EXCLUDE (_rn) FROM shipments_ranked WHERE _rn = 1),
curated_shipments AS (
  SELECT * EXCLUDE (late_delivery),
         COALESCE(late_delivery, FALSE) AS late_delivery,
         CASE WHEN actual_delivery_at IS NOT NULL AND estimated_delivery_at IS NOT NULL
              THEN CAST(sign(date_diff('second', estimated_delivery_at, actual_delivery_at))
                        * ((200 * abs(date_diff('second', estimated_delivery_at, actual_delivery_at)) + 3600) // 7200)
                        AS DOUBLE) / 100 END AS delivery_delay_hours
  FROM dedup_shipments
  WHERE shipment_id IS NOT NULL AND order_id IS NOT NULL AND shipped_at IS NOT NULL),
fact_shipment AS (
  SELECT * REPLACE (CAST(delivery_delay_hours AS DECIMAL(8,2)) AS delivery_delay_hours) FROM curated_shipments),
curated_returns AS (
  SELECT * EXCLUDE (_rn) FROM (
    SELECT *, ROW_NUMBER() OVER (
             PARTITION BY record_id
             ORDER BY reported_at DESC NULLS LAST, order_id DESC NULLS LAST, warehouse_id DESC NULLS LAST,
                      product_category DESC NULLS LAST, report_type DESC NULLS LAST, defect_type DESC NULLS LAST,
                      units_affected DESC NULLS LAST, refund_issued DESC NULLS LAST,
                      root_cause_category DESC NULLS LAST, event_date DESC NULLS LAST) AS _rn
    FROM fx_returns_dirty
    WHERE record_id IS NOT NULL AND order_id IS NOT NULL AND report_type IS NOT NULL)
  WHERE _rn = 1),
dim_warehouse AS (
  SELECT *, snapshot_date AS effective_start_date,
         LEAD(snapshot_date, 1) OVER (PARTITION BY warehouse_id ORDER BY snapshot_date ASC NULLS LAST)
           AS effective_end_date,
         LEAD(snapshot_date, 1) OVER (PARTITION BY warehouse_id ORDER BY snapshot_date ASC NULLS LAST) IS NULL
           AS is_current
  FROM fx_warehouse_capacity),
dim_product_category AS (
  SELECT * FROM (VALUES {CAT_ROWS}) t(category_name, sla_hours)),
dim_carrier AS (
  SELECT * FROM (VALUES {CARRIER_ROWS}) t(carrier_name, carrier_type)),
dim_date AS (
  SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_sk, CAST(d AS DATE) AS full_date,
         dayname(d) AS day_of_week, CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week_num,
         CAST(day(d) AS INTEGER) AS day_of_month, CAST(weekofyear(d) AS INTEGER) AS week_of_year,
         CAST(month(d) AS INTEGER) AS month_num, monthname(d) AS month_name,
         CAST(quarter(d) AS INTEGER) AS quarter, CAST(year(d) AS INTEGER) AS year,
         dayofweek(d) IN (0, 6) AS is_weekend, dayofweek(d) NOT IN (0, 6) AS is_weekday
  FROM generate_series(DATE '2024-01-01', DATE '2027-12-31', INTERVAL 1 DAY) AS g(d))
"""


def with_fixtures(select: str) -> str:
    return "WITH " + FIXTURES.strip() + "\n" + select.strip()


def _count_if(p: str) -> str:
    return f"CAST(SUM(CASE WHEN {p} THEN 1 ELSE 0 END) AS BIGINT)"


M1 = f"""
SELECT o.event_date, o.warehouse_id, d.day_of_week, d.is_weekend,
       COUNT(*) AS total_orders,
       CAST(SUM(o.units_ordered) AS BIGINT) AS total_units,
       CAST(SUM(o.order_value_usd) AS DOUBLE) AS total_revenue_usd,
       {_count_if("o.order_status = 'DELIVERED'")} AS delivered_orders,
       {_count_if("o.order_status = 'CANCELLED'")} AS cancelled_orders,
       {_count_if("o.order_status = 'RETURNED'")} AS returned_orders,
       {_count_if("o.sla_breach = TRUE")} AS sla_breaches,
       {pct_sql(_count_if("o.order_status = 'DELIVERED'"), "COUNT(*)")} AS delivery_rate_pct,
       {pct_sql(_count_if("o.sla_breach = TRUE"), "COUNT(*)")} AS sla_breach_rate_pct,
       {pct_sql(_count_if("o.order_status = 'CANCELLED'"), "COUNT(*)")} AS cancellation_rate_pct,
       {avg2_sql("CASE WHEN o.processing_hours > 0 THEN o.processing_hours END")} AS avg_processing_hours,
       {_count_if("o.prime_member = TRUE")} AS prime_orders,
       {_count_if("o.prime_member = FALSE")} AS non_prime_orders
FROM fact_order o
LEFT JOIN dim_date d ON o.event_date = d.full_date
GROUP BY o.event_date, o.warehouse_id, d.day_of_week, d.is_weekend
"""

M2 = f"""
SELECT event_date, warehouse_id, shift,
       COUNT(*) AS orders_processed,
       CAST(SUM(units_ordered) AS BIGINT) AS units_processed,
       {avg2_sql("processing_hours")} AS avg_processing_hours,
       {_count_if("sla_breach = TRUE")} AS sla_breaches,
       {pct_sql(_count_if("sla_breach = TRUE"), "COUNT(*)")} AS sla_breach_rate_pct,
       CAST(SUM(order_value_usd) AS DOUBLE) AS shift_revenue_usd,
       CAST(RANK() OVER (PARTITION BY event_date, warehouse_id ORDER BY COUNT(*) DESC) AS INTEGER)
         AS shift_rank_by_volume
FROM fact_order
GROUP BY event_date, warehouse_id, shift
"""

_W7 = "OVER (PARTITION BY carrier ORDER BY event_date ASC NULLS LAST ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"
M3 = f"""
SELECT event_date, carrier, total_shipments, late_shipments, on_time_shipments,
       {pct_sql("on_time_shipments", "total_shipments")} AS on_time_rate_pct,
       avg_delay_hours, max_delay_hours,
       {pct_sql(f"SUM(on_time_shipments) {_W7}", f"SUM(total_shipments) {_W7}")} AS rolling_7d_on_time_pct
FROM (
  SELECT event_date, carrier,
         COUNT(*) AS total_shipments,
         {_count_if("late_delivery = TRUE")} AS late_shipments,
         {_count_if("late_delivery = FALSE")} AS on_time_shipments,
         {avg2_sql("CASE WHEN delivery_delay_hours > 0 THEN delivery_delay_hours END")} AS avg_delay_hours,
         CAST(MAX(delivery_delay_hours) AS DOUBLE) AS max_delay_hours
  FROM fact_shipment GROUP BY event_date, carrier) a
"""

M4 = f"""
SELECT r.event_date, r.warehouse_id, r.product_category, r.report_type, r.defect_type, r.root_cause_category,
       COUNT(*) AS total_incidents,
       CAST(SUM(r.units_affected) AS BIGINT) AS total_units_affected,
       {_count_if("r.refund_issued = TRUE")} AS refunds_issued,
       {pct_sql(_count_if("r.refund_issued = TRUE"), "COUNT(*)")} AS refund_rate_pct,
       {pct_sql("COUNT(*)", "(SELECT COUNT(*) FROM fact_order o WHERE o.warehouse_id = r.warehouse_id AND o.event_date = r.event_date)")} AS defect_rate_pct
FROM curated_returns r
GROUP BY r.event_date, r.warehouse_id, r.product_category, r.report_type, r.defect_type, r.root_cause_category
"""

_WH = "OVER (PARTITION BY warehouse_id ORDER BY snapshot_date ASC NULLS LAST)"
_WH7 = "OVER (PARTITION BY warehouse_id ORDER BY snapshot_date ASC NULLS LAST ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"
M5 = f"""
SELECT snapshot_date, warehouse_id, warehouse_name, region, max_daily_capacity, units_processed,
       CAST(utilization_pct AS DOUBLE) AS utilization_pct, headcount, active_shifts,
       CAST(utilization_pct - LAG(utilization_pct, 7) {_WH} AS DOUBLE) AS wow_utilization_change,
       COALESCE(utilization_pct > 95, FALSE) AS is_near_capacity,
       {avg2_sql("utilization_pct", _WH7)} AS rolling_7d_avg_utilization
FROM dim_warehouse
WHERE is_current = TRUE OR effective_end_date IS NOT NULL
"""

M6 = f"""
SELECT MIN(event_date) AS period_start, MAX(event_date) AS period_end,
       COUNT(*) AS total_orders,
       CAST(SUM(units_ordered) AS BIGINT) AS total_units,
       CAST(SUM(order_value_usd) AS DOUBLE) AS total_revenue_usd,
       {avg2_sql("order_value_usd")} AS avg_order_value_usd,
       {pct_sql(_count_if("order_status = 'DELIVERED'"), "COUNT(*)")} AS overall_delivery_rate_pct,
       {pct_sql(_count_if("sla_breach = TRUE"), "COUNT(*)")} AS overall_sla_breach_rate_pct,
       {pct_sql(_count_if("order_status = 'CANCELLED'"), "COUNT(*)")} AS overall_cancellation_rate_pct,
       {pct_sql(_count_if("order_status = 'RETURNED'"), "COUNT(*)")} AS overall_return_rate_pct,
       {avg2_sql("CASE WHEN processing_hours > 0 THEN processing_hours END")} AS avg_processing_hours,
       {_count_if("prime_member = TRUE")} AS prime_orders,
       {pct_sql(_count_if("prime_member = TRUE"), "COUNT(*)")} AS prime_order_pct
FROM fact_order
"""

from fulfilq.oracle_more import MORE  # noqa: E402

QUERIES: dict[str, str] = {
    **MORE,
    "daily_ops_scorecard": M1,
    "shift_performance": M2,
    "carrier_performance": M3,
    "defect_analysis": M4,
    "warehouse_utilization": M5,
    "executive_summary": M6,
}


def oracle_sql() -> dict[str, str]:
    return {name: with_fixtures(sql) for name, sql in QUERIES.items()}
