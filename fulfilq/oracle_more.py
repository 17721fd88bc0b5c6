"""Oracle SQL for the non-mart queries (curated, dedup, upsert, checks, derivations)."""

from __future__ import annotations

from fulfilq.oracle import M3, pct_sql

# Fixed values, restated here so that a wrong constant of the library shows.
ORDER_STATUSES = ["PLACED", "PICKED", "PACKED", "SHIPPED", "DELIVERED", "CANCELLED", "RETURNED"]
SHIPPED_STATUSES = ["SHIPPED", "DELIVERED", "RETURNED"]
REPORT_TYPES = ["RETURN", "DEFECT"]
EXPECTED_WAREHOUSE_IDS = ["FC_01", "FC_02", "FC_03", "FC_04", "FC_05", "FC_99"]


def _in(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def _desc(cols) -> str:
    return ", ".join(f"{c} DESC NULLS LAST" for c in cols)


def _fails(p: str) -> str:
    return f"COUNT(*) FILTER (WHERE NOT COALESCE({p}, FALSE))"


def _checks_sql(dataset: str, source: str, specs) -> str:
    parts = []
    for cid, name, sev, viol, obs, passed in specs:
        parts.append(
            f"SELECT '{dataset}' AS dataset, '{cid}' AS check_id, '{name}' AS check_name, '{sev}' AS severity, "
            f"CAST({viol or 'NULL'} AS BIGINT) AS violations, CAST({obs or 'NULL'} AS DOUBLE) AS observed, "
            f"{passed} AS passed FROM {source}")
    return "\nUNION ALL\n".join(parts)


SHIPPED = _in(SHIPPED_STATUSES)

ORDER_COLS = ["warehouse_id", "product_category", "order_status", "shipped_at", "delivered_at", "shift",
              "units_ordered", "order_value_usd", "prime_member", "sla_breach", "processing_hours", "event_date"]
RETURN_COLS = ["order_id", "warehouse_id", "product_category", "report_type", "defect_type", "units_affected",
               "refund_issued", "root_cause_category", "event_date"]

DEDUP_ORDERS = f"""
SELECT * EXCLUDE (_rn) FROM (
  SELECT * REPLACE (CAST(order_value_usd AS DOUBLE) AS order_value_usd,
                    CAST(processing_hours AS DOUBLE) AS processing_hours),
         ROW_NUMBER() OVER (PARTITION BY order_id ORDER BY placed_at DESC NULLS LAST, {_desc(ORDER_COLS)}) AS _rn
  FROM fx_order_events_dirty)
WHERE _rn = 1
"""

DEDUP_RETURNS = f"""
SELECT * EXCLUDE (_rn) FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY record_id ORDER BY reported_at DESC NULLS LAST, {_desc(RETURN_COLS)}) AS _rn
  FROM fx_returns_dirty)
WHERE _rn = 1
"""

NULL_AUDIT = "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, COUNT(*) FILTER (WHERE {c} IS NULL) AS null_count FROM fx_order_events_dirty"
    for c in ["order_id", "warehouse_id", "product_category", "order_status", "placed_at", "order_value_usd"])

HOURS = ("CASE WHEN shipped_at IS NOT NULL THEN CAST(sign(date_diff('second', placed_at, shipped_at)) * "
         "((200 * abs(date_diff('second', placed_at, shipped_at)) + 3600) // 7200) AS DOUBLE) / 100 END")

_Q_ORDERS_SRC = f"""(SELECT COUNT(*) AS n, COUNT(DISTINCT order_id) AS n_ids,
   COUNT(*) FILTER (WHERE order_id IS NULL) AS null_id,
   COUNT(*) FILTER (WHERE warehouse_id IS NULL) AS null_wh,
   COUNT(*) FILTER (WHERE order_status IS NULL) AS null_status,
   COUNT(*) FILTER (WHERE placed_at IS NULL) AS null_placed,
   {_fails(f"order_status IN {_in(ORDER_STATUSES)}")} AS bad_status,
   {_fails("order_value_usd > 0")} AS bad_value,
   {_fails("units_ordered >= 1")} AS bad_units,
   SUM(CAST(sla_breach AS INTEGER)) AS breaches, COUNT(sla_breach) AS breach_known,
   COUNT(*) FILTER (WHERE order_status = 'CANCELLED') AS cancelled,
   COUNT(*) FILTER (WHERE order_status = 'RETURNED') AS returned,
   COUNT(*) FILTER (WHERE order_status IN {SHIPPED} AND shipped_at IS NULL) AS no_ship_ts,
   COUNT(*) FILTER (WHERE order_status = 'DELIVERED' AND delivered_at IS NULL) AS no_deliv_ts,
   date_diff('day', MIN(event_date), MAX(event_date)) AS span,
   COUNT(DISTINCT event_date) AS n_days
 FROM fx_order_events_dirty) a"""
_SLA = "(CAST(breaches AS DOUBLE) / NULLIF(breach_known, 0))"
_CAN = "(CAST(cancelled AS DOUBLE) / NULLIF(n, 0))"
_RET = "(CAST(returned AS DOUBLE) / NULLIF(n, 0))"
QUALITY_ORDERS = _checks_sql("order_events", _Q_ORDERS_SRC, [
    ("Q1", "row count: at least 1000", "error", None, "n", "n >= 1000"),
    ("Q2", "order_id: unique", "error", "n - n_ids", None, "n = n_ids"),
    ("Q3", "order_id: no NULLs", "error", "null_id", None, "null_id = 0"),
    ("Q4", "warehouse_id: no NULLs", "error", "null_wh", None, "null_wh = 0"),
    ("Q5", "order_status: no NULLs", "error", "null_status", None, "null_status = 0"),
    ("Q6", "placed_at: no NULLs", "error", "null_placed", None, "null_placed = 0"),
    ("Q7", "order_status: in domain", "error", "bad_status", None, "bad_status = 0"),
    ("Q8", "order_value_usd: above 0", "error", "bad_value", None, "bad_value = 0"),
    ("Q9", "units_ordered: at least 1", "error", "bad_units", None, "bad_units = 0"),
    ("Q10", "sla_breach share: below 0.15", "warn", None, _SLA, f"COALESCE({_SLA} < 0.15, FALSE)"),
    ("Q11", "CANCELLED share: between 0.01 and 0.1", "error", None, _CAN, f"COALESCE({_CAN} BETWEEN 0.01 AND 0.10, FALSE)"),
    ("Q12", "RETURNED share: between 0.01 and 0.1", "error", None, _RET, f"COALESCE({_RET} BETWEEN 0.01 AND 0.10, FALSE)"),
    ("Q13", "shipped_at: present once shipped", "error", "no_ship_ts", None, "no_ship_ts = 0"),
    ("Q14", "delivered_at: present once delivered", "error", "no_deliv_ts", None, "no_deliv_ts = 0"),
    ("Q15", "event_date span: at least 28", "error", None, "span", "COALESCE(span >= 28, FALSE)"),
    ("Q15b", "event_date: no missing days", "warn", "span + 1 - n_days", None, "COALESCE(span + 1 - n_days = 0, TRUE)"),
])

ORPHAN_SHIPMENTS = f"""
SELECT s.shipment_id, s.order_id FROM fx_shipments_dirty s
WHERE NOT EXISTS (SELECT 1 FROM fx_order_events_dirty o
                  WHERE o.order_status IN {SHIPPED} AND o.order_id = s.order_id)
"""
UNCOVERED_ORDERS = f"""
SELECT DISTINCT o.order_id FROM fx_order_events_dirty o
WHERE o.order_status IN {SHIPPED}
  AND NOT EXISTS (SELECT 1 FROM fx_shipments_dirty s WHERE s.order_id = o.order_id)
"""
ORPHAN_RETURNS = """
SELECT r.record_id, r.order_id FROM fx_returns_dirty r
WHERE r.report_type = 'RETURN'
  AND NOT EXISTS (SELECT 1 FROM fx_order_events_dirty o WHERE o.order_status = 'RETURNED' AND o.order_id = r.order_id)
"""
_EXPECTED = "(SELECT * FROM (VALUES " + ", ".join(f"('{w}')" for w in EXPECTED_WAREHOUSE_IDS) + ") t(warehouse_id))"
UNKNOWN_WAREHOUSES = f"""
SELECT f.warehouse_id, 'unexpected' AS issue FROM (SELECT DISTINCT warehouse_id FROM fx_warehouse_capacity) f
WHERE NOT EXISTS (SELECT 1 FROM {_EXPECTED} e WHERE e.warehouse_id = f.warehouse_id)
UNION ALL
SELECT e.warehouse_id, 'missing' AS issue FROM (SELECT DISTINCT warehouse_id FROM {_EXPECTED}) e
WHERE NOT EXISTS (SELECT 1 FROM fx_warehouse_capacity f WHERE f.warehouse_id = e.warehouse_id)
"""

_Q_SHIP_SRC = """(SELECT COUNT(*) AS n, COUNT(DISTINCT shipment_id) AS n_ids,
   COUNT(*) FILTER (WHERE carrier IS NULL) AS null_carrier,
   COUNT(*) FILTER (WHERE tracking_number IS NULL) AS null_tracking,
   SUM(CAST(late_delivery AS INTEGER)) AS late, COUNT(late_delivery) AS late_known
 FROM fx_shipments_dirty) a"""
_LATE = "(CAST(late AS DOUBLE) / NULLIF(late_known, 0))"
QUALITY_SHIPMENTS = "\nUNION ALL\n".join([
    _checks_sql("shipment_tracking", f"(SELECT COUNT(*) AS orphans FROM ({ORPHAN_SHIPMENTS}) x) a", [
        ("Q20", "order_id: refers to a shipped order", "error", "orphans", None, "orphans = 0")]),
    _checks_sql("shipment_tracking", f"(SELECT COUNT(*) AS missing FROM ({UNCOVERED_ORDERS}) x) a", [
        ("Q21", "shipped order_id: has a shipment", "warn", "missing", None, "missing = 0")]),
    _checks_sql("shipment_tracking", _Q_SHIP_SRC, [
        ("Q16", "row count: above 0", "error", None, "n", "n > 0"),
        ("Q17", "shipment_id: unique", "error", "n - n_ids", None, "n = n_ids"),
        ("Q18", "carrier: no NULLs", "error", "null_carrier", None, "null_carrier = 0"),
        ("Q19", "tracking_number: no NULLs", "error", "null_tracking", None, "null_tracking = 0"),
        ("Q22", "late_delivery share: below 0.15", "warn", None, _LATE, f"COALESCE({_LATE} < 0.15, FALSE)"),
    ]),
])

_Q_CAP_SRC = f"""(SELECT {_fails("utilization_pct BETWEEN 0 AND 100")} AS bad_util,
   {_fails("units_processed <= max_daily_capacity")} AS over_cap,
   {_fails("headcount > 0")} AS bad_headcount,
   date_diff('day', MIN(snapshot_date), MAX(snapshot_date)) AS span
 FROM fx_warehouse_capacity) a"""
QUALITY_CAPACITY = "\nUNION ALL\n".join([
    _checks_sql("warehouse_capacity", f"(SELECT COUNT(*) AS wh_diff FROM ({UNKNOWN_WAREHOUSES}) x) a", [
        ("Q23", "warehouse_id: as expected", "error", "wh_diff", None, "wh_diff = 0")]),
    _checks_sql("warehouse_capacity", _Q_CAP_SRC, [
        ("Q24", "utilization_pct: between 0 and 100", "error", "bad_util", None, "bad_util = 0"),
        ("Q25", "units_processed: at most max_daily_capacity", "error", "over_cap", None, "over_cap = 0"),
        ("Q26", "headcount: above 0", "error", "bad_headcount", None, "bad_headcount = 0"),
        ("Q27", "snapshot_date span: at least 28", "error", None, "span", "COALESCE(span >= 28, FALSE)"),
    ]),
])

_RET_ALL = ["record_id", *RETURN_COLS, "reported_at"]
_Q_RET_SRC = f"""(SELECT COUNT(*) AS n,
   COUNT(*) FILTER (WHERE {' OR '.join(f'{c} IS NULL' for c in _RET_ALL)}) AS rows_with_null,
   COUNT(DISTINCT record_id) AS n_ids,
   {_fails(f"report_type IN {_in(REPORT_TYPES)}")} AS bad_type,
   {_fails("units_affected >= 1")} AS bad_units
 FROM fx_returns_dirty) a"""
QUALITY_RETURNS = "\nUNION ALL\n".join([
    _checks_sql("returns_defects", f"(SELECT COUNT(*) AS orphans FROM ({ORPHAN_RETURNS}) x) a", [
        ("Q32", "order_id: refers to a returned order", "error", "orphans", None, "orphans = 0")]),
    _checks_sql("returns_defects", _Q_RET_SRC, [
        ("Q28", "row count: above 0", "error", None, "n", "(rows_with_null = 0 OR n > 0)"),
        ("Q29", "record_id: unique", "error", "n - n_ids", None, "n = n_ids"),
        ("Q30", "report_type: in domain", "error", "bad_type", None, "bad_type = 0"),
        ("Q31", "units_affected: at least 1", "error", "bad_units", None, "bad_units = 0"),
    ]),
])


def _smoke(dataset: str, table: str, null_key: str) -> str:
    src = f"(SELECT COUNT(*) AS n, COUNT(*) FILTER (WHERE {null_key}) AS null_keys FROM {table}) a"
    return _checks_sql(dataset, src, [
        ("Q33a", "row count: above 0", "error", None, "n", "n > 0"),
        ("Q33b", "ingested_at: present", "error", None, None, "TRUE"),
        ("Q33c", "key: no NULLs", "error", "null_keys", None, "null_keys = 0"),
    ])


CURATED_SMOKE = "\nUNION ALL\n".join([
    _smoke("order_events", "curated_orders", "order_id IS NULL"),
    _smoke("returns_defects", "curated_returns", "record_id IS NULL"),
    _smoke("shipment_tracking", "curated_shipments", "shipment_id IS NULL"),
    _smoke("warehouse_capacity", "dim_warehouse", "warehouse_id IS NULL OR effective_start_date IS NULL"),
])

_OLD, _NEW = "DATE '2024-01-21'", "DATE '2024-01-15'"


def _upsert_sql(table: str, key: str, stale_col: str, stale_expr: str) -> str:
    return f"""
, u_old AS (SELECT * REPLACE (CASE WHEN event_date >= {_NEW} THEN {stale_expr} ELSE {stale_col} END AS {stale_col})
            FROM {table} WHERE event_date < {_OLD}),
u_new AS (SELECT * FROM {table} WHERE event_date >= {_NEW})
SELECT * FROM u_old o WHERE NOT EXISTS (SELECT 1 FROM u_new n WHERE n.{key} = o.{key})
UNION ALL
SELECT * FROM u_new
"""


_CAP_COLS = ("snapshot_date, warehouse_id, warehouse_name, region, max_daily_capacity, units_processed, "
             "utilization_pct, active_shifts, headcount")
_SCD = ("snapshot_date AS effective_start_date, "
        "LEAD(snapshot_date, 1) OVER (PARTITION BY warehouse_id ORDER BY snapshot_date ASC NULLS LAST) "
        "AS effective_end_date, "
        "LEAD(snapshot_date, 1) OVER (PARTITION BY warehouse_id ORDER BY snapshot_date ASC NULLS LAST) IS NULL "
        "AS is_current")
UPSERT_WAREHOUSE = f"""
, u_snaps AS (SELECT * REPLACE (CAST(utilization_pct AS DOUBLE) AS utilization_pct) FROM fx_warehouse_capacity),
u_old AS (SELECT * FROM u_snaps WHERE snapshot_date < {_OLD}),
u_new AS (SELECT * FROM u_snaps WHERE snapshot_date >= {_NEW}),
u_hist AS (SELECT {_CAP_COLS}, {_SCD} FROM u_old),
u_touched AS (SELECT DISTINCT warehouse_id FROM u_new),
u_merged AS (
  SELECT {_CAP_COLS} FROM u_hist h
  WHERE h.warehouse_id IN (SELECT warehouse_id FROM u_touched)
    AND NOT EXISTS (SELECT 1 FROM u_new n WHERE n.warehouse_id = h.warehouse_id AND n.snapshot_date = h.snapshot_date)
  UNION ALL
  SELECT {_CAP_COLS} FROM u_new)
SELECT * FROM u_hist WHERE warehouse_id NOT IN (SELECT warehouse_id FROM u_touched)
UNION ALL
SELECT {_CAP_COLS}, {_SCD} FROM u_merged
"""

TABLE_ROW_COUNTS = "\nUNION ALL\n".join(
    f"SELECT '{name}' AS table_name, COUNT(*) AS row_count FROM {src}"
    for name, src in [("dim_carrier", "dim_carrier"), ("dim_date", "dim_date"),
                      ("dim_product_category", "dim_product_category"), ("dim_warehouse", "dim_warehouse"),
                      ("fact_order", "fact_order"), ("fact_returns_defects", "curated_returns"),
                      ("fact_shipment", "curated_shipments")])

PIPELINE_AUDIT = "\nUNION ALL\n".join(
    f"SELECT 'fulfilq_load' AS job_name, '{t}' AS target_table, (SELECT COUNT(*) FROM {src}) AS rows_loaded, "
    f"'SUCCESS' AS run_status, {wm} AS watermark_date"
    for t, src, wm in [
        ("fact_order", "curated_orders", "(SELECT MAX(event_date) FROM curated_orders)"),
        ("fact_shipment", "curated_shipments", "(SELECT MAX(event_date) FROM curated_shipments)"),
        ("dim_warehouse", "dim_warehouse", "CAST(NULL AS DATE)"),
        ("fact_returns_defects", "curated_returns", "CAST(NULL AS DATE)"),
    ])

# What two batches must leave: every row once, the undated ones without a date.
STORED_ORDERS = """
SELECT order_id, warehouse_id, product_category, order_status, placed_at, shipped_at, delivered_at, shift,
       units_ordered, CAST(order_value_usd AS DOUBLE) AS order_value_usd, prime_member, sla_breach,
       CAST(processing_hours AS DOUBLE) AS processing_hours, order_day_of_week, is_weekend, fulfillment_speed_tier,
       CASE WHEN units_ordered <> 5 THEN event_date END AS event_date
FROM fact_order"""
STORED_SHIPMENTS = """
SELECT shipment_id, order_id, warehouse_id, carrier, tracking_number, shipped_at, estimated_delivery_at,
       actual_delivery_at, delivery_status, late_delivery, CAST(delivery_delay_hours AS DOUBLE) AS delivery_delay_hours,
       CASE WHEN carrier <> 'OnTrac' THEN event_date END AS event_date
FROM fact_shipment"""
# The second run reads from the first mark on and leaves what one run over all days would.
WATERMARKS = "\nUNION ALL\n".join(
    f"SELECT '{t}' AS target_table, MAX(event_date) FILTER (WHERE event_date <= DATE '2024-01-15') AS first_mark, "
    f"MAX(event_date) AS second_mark, COUNT(*) AS row_count FROM {t}" for t in ("fact_order", "fact_shipment"))
STORED_RETURNS = """
SELECT record_id, order_id, warehouse_id, product_category, report_type, defect_type, reported_at, units_affected,
       refund_issued, root_cause_category, CASE WHEN units_affected <> 5 THEN event_date END AS event_date
FROM curated_returns"""
LANDED_RETURNS = """
SELECT * REPLACE (CASE WHEN report_type IS DISTINCT FROM 'RETURN' THEN root_cause_category END AS root_cause_category)
FROM fx_returns_dirty"""
CLEANSE_COUNTS = "\nUNION ALL\n".join(
    f"SELECT '{n}' AS dataset, r AS raw_rows, c AS curated_rows, r - c AS removed_rows "
    f"FROM (SELECT (SELECT COUNT(*) FROM {raw}) AS r, (SELECT COUNT(*) FROM {cur}) AS c)"
    for n, raw, cur in (("order_events", "fx_order_events_dirty", "curated_orders"),
                        ("shipment_tracking", "fx_shipments_dirty", "curated_shipments"),
                        ("warehouse_capacity", "fx_warehouse_capacity", "dim_warehouse"),
                        ("returns_defects", "fx_returns_dirty", "curated_returns")))
LANDED_ORDERS = """
SELECT order_id, warehouse_id, product_category, order_status,
       CASE WHEN units_ordered <> 3 THEN placed_at END AS placed_at, shipped_at, delivered_at, shift,
       CASE WHEN units_ordered <> 7 THEN units_ordered END AS units_ordered,
       CASE WHEN units_ordered <> 6 THEN CAST(order_value_usd AS DOUBLE) END AS order_value_usd,
       CASE WHEN units_ordered <> 2 THEN prime_member END AS prime_member, sla_breach,
       CAST(processing_hours AS DOUBLE) AS processing_hours, event_date
FROM fx_order_events_dirty"""

MORE: dict[str, str] = {
    "stored_upsert_orders": STORED_ORDERS,
    "stored_upsert_shipments": STORED_SHIPMENTS,
    "stored_upsert_returns": STORED_RETURNS,
    "landed_returns": LANDED_RETURNS,
    "curated_rerun": "SELECT * FROM curated_orders",
    "curated_files_smoke": CURATED_SMOKE,
    "cleanse_counts": CLEANSE_COUNTS,
    "calendar_orders": """
SELECT d.*, COALESCE(c.orders, 0) AS orders
FROM dim_date d
LEFT JOIN (SELECT event_date, COUNT(*) AS orders FROM fact_order GROUP BY event_date) c ON c.event_date = d.full_date""",
    "carrier_ranking": f"""
SELECT event_date, carrier, on_time_rate_pct,
       ROW_NUMBER() OVER (ORDER BY event_date DESC NULLS FIRST, on_time_rate_pct ASC NULLS LAST, carrier) AS position
FROM ({M3})""",
    "view_scorecard": """
SELECT warehouse_id, COUNT(*) AS days, MAX(n) AS most_orders, CAST(SUM(n) AS BIGINT) AS orders
FROM (SELECT event_date, warehouse_id, COUNT(*) AS n FROM fact_order WHERE event_date IN (SELECT full_date FROM dim_date)
      GROUP BY event_date, warehouse_id)
GROUP BY warehouse_id""",
    "watermark_advance": WATERMARKS,
    "landed_orders": LANDED_ORDERS,
    "pipeline_audit": PIPELINE_AUDIT,
    "table_row_counts": TABLE_ROW_COUNTS,
    "order_status_mix": f"""
SELECT order_status, COUNT(*) AS orders, {pct_sql("COUNT(*)", "SUM(COUNT(*)) OVER ()")} AS share_pct
FROM fx_order_events_dirty GROUP BY order_status""",
    "curated_orders": "SELECT * FROM curated_orders",
    "curated_shipments": "SELECT * FROM curated_shipments",
    "curated_returns": "SELECT * FROM curated_returns",
    "warehouse_scd2": "SELECT * REPLACE (CAST(utilization_pct AS DOUBLE) AS utilization_pct) FROM dim_warehouse",
    "dedup_orders": DEDUP_ORDERS,
    "dedup_shipments": "SELECT * FROM dedup_shipments",
    "dedup_returns": DEDUP_RETURNS,
    "calendar_coverage": """
SELECT d.*, COALESCE(c.orders, 0) AS orders
FROM dim_date d
JOIN (SELECT MIN(event_date) AS lo, MAX(event_date) AS hi FROM fact_order) s ON d.full_date BETWEEN s.lo AND s.hi
LEFT JOIN (SELECT event_date, COUNT(*) AS orders FROM fact_order GROUP BY event_date) c ON c.event_date = d.full_date
""",
    "carrier_type_mix": """
SELECT c.carrier_type, COUNT(*) AS shipments, COUNT(*) FILTER (WHERE s.late_delivery) AS late_shipments
FROM fact_shipment s LEFT JOIN dim_carrier c ON c.carrier_name = s.carrier
GROUP BY c.carrier_type""",
    "upsert_orders": _upsert_sql("curated_orders", "order_id", "order_status", "'PLACED'"),
    "upsert_shipments": _upsert_sql("curated_shipments", "shipment_id", "late_delivery", "NOT late_delivery"),
    "upsert_returns": _upsert_sql("curated_returns", "record_id", "refund_issued", "NOT refund_issued"),
    "upsert_warehouse": UPSERT_WAREHOUSE,
    "incremental_orders": "SELECT * FROM curated_orders WHERE event_date >= DATE '2024-01-15'",
    "sla_breach_recomputed": """
SELECT o.order_id, o.product_category, CAST(COALESCE(c.sla_hours, 48) AS INTEGER) AS sla_hours,
       CASE WHEN o.shipped_at IS NULL THEN TRUE
            ELSE date_diff('second', o.placed_at, o.shipped_at) > COALESCE(c.sla_hours, 48) * 3600 END
         AS sla_breach_recomputed,
       o.sla_breach AS sla_breach_stored
FROM curated_orders o LEFT JOIN dim_product_category c ON c.category_name = o.product_category""",
    "shift_bucket": """
SELECT order_id, CAST(hour(placed_at) AS INTEGER) AS placed_hour,
       CASE WHEN hour(placed_at) BETWEEN 6 AND 13 THEN 'Morning'
            WHEN hour(placed_at) BETWEEN 14 AND 21 THEN 'Afternoon' ELSE 'Night' END AS shift_recomputed,
       shift AS shift_stored
FROM curated_orders""",
    "processing_hours": f"""
SELECT order_id, {HOURS} AS processing_hours_recomputed, processing_hours AS processing_hours_stored
FROM curated_orders""",
    "late_flag": """
SELECT shipment_id, COALESCE(actual_delivery_at > estimated_delivery_at, FALSE) AS late_recomputed,
       late_delivery AS late_stored
FROM curated_shipments""",
    "delivery_delay": """
SELECT carrier, delivery_status, COUNT(*) AS shipments, COUNT(delivery_delay_hours) AS with_delay,
       CAST(SUM(CAST(delivery_delay_hours AS DECIMAL(12,2))) AS DOUBLE) AS delay_hours_sum,
       MIN(delivery_delay_hours) AS min_delay_hours, MAX(delivery_delay_hours) AS max_delay_hours
FROM curated_shipments GROUP BY carrier, delivery_status""",
    "orphan_shipments": ORPHAN_SHIPMENTS,
    "uncovered_orders": UNCOVERED_ORDERS,
    "orphan_returns": ORPHAN_RETURNS,
    "unknown_warehouses": UNKNOWN_WAREHOUSES,
    "null_audit_orders": NULL_AUDIT,
    "quality_orders": QUALITY_ORDERS,
    "quality_shipments": QUALITY_SHIPMENTS,
    "quality_capacity": QUALITY_CAPACITY,
    "quality_returns": QUALITY_RETURNS,
    "curated_smoke": CURATED_SMOKE,
}
