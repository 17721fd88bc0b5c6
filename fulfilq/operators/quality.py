"""Data-quality suite (Q1-Q33) as Spark aggregates.

Each dataset's checks are ONE global aggregate (partial per task, one row
out). Referential checks that count are joins of per-id counts (a partial
aggregate before the shuffle, so a hot id is one row per task). Those that list
rows are anti joins: the build side is reduced to distinct ids, rows without
an id bypass the join (they match nothing), and the rows of the most frequent
ids are settled by a broadcast of at most ``HEAVY_IDS`` verdicts. Where Q32 only
counts, per-id counts are joined. The result is a
DataFrame with one row per check:

    dataset, check_id, check_name, severity ('error' | 'warn'),
    violations (BIGINT, NULL for threshold checks), observed (DOUBLE), passed

Semantics follow the reference's pandas validator: a NULL in a compared
column counts as a violation (``(NaN > 0).all()`` is false), rates of an
equality test count NULL as "not equal" in the denominator, and boolean
column means skip NULLs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fulfilq.schemas import ORDER_STATUSES, REPORT_TYPES, SHIPPED_STATUSES

RESULT_COLUMNS = ["dataset", "check_id", "check_name", "severity", "violations", "observed", "passed"]


def _fails(pred: Column) -> Column:
    """Rows where ``pred`` is false or NULL."""
    return F.count_if(~F.coalesce(pred, F.lit(False)))


def _ratio(n: Column, d: Column) -> Column:
    return n.cast("double") / F.nullif(d, F.lit(0)).cast("double")


def _checks(dataset: str, agg_row: DataFrame, specs: list[tuple]) -> DataFrame:
    """Turn one aggregate row into check rows. spec = (id, name, severity, violations, observed, passed)."""
    structs = [
        F.struct(
            F.lit(cid).alias("check_id"), F.lit(name).alias("check_name"), F.lit(sev).alias("severity"),
            (viol if viol is not None else F.lit(None)).cast("bigint").alias("violations"),
            (obs if obs is not None else F.lit(None)).cast("double").alias("observed"),
            passed.alias("passed"),
        )
        for cid, name, sev, viol, obs, passed in specs
    ]
    return agg_row.select(F.lit(dataset).alias("dataset"), F.inline(F.array(*structs)))


def rule(subject: str, predicate: str, *bounds) -> str:
    """A check's name, from what it looks at, what it demands and the bounds; ``check_id`` is the stable key."""
    return f"{subject}: {predicate} {' and '.join(map(str, bounds))}".rstrip()


def _zero(c: str) -> Column:
    return F.col(c) == 0


def quality_orders(orders: DataFrame) -> DataFrame:
    """Q1-Q15 over raw order events (typed)."""
    st = F.col("order_status")
    a = orders.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_distinct("order_id").alias("n_ids"),
        F.count_if(F.col("order_id").isNull()).alias("null_id"),
        F.count_if(F.col("warehouse_id").isNull()).alias("null_wh"),
        F.count_if(st.isNull()).alias("null_status"),
        F.count_if(F.col("placed_at").isNull()).alias("null_placed"),
        _fails(st.isin(*ORDER_STATUSES)).alias("bad_status"),
        _fails(F.col("order_value_usd") > 0).alias("bad_value"),
        _fails(F.col("units_ordered") >= 1).alias("bad_units"),
        F.sum(F.col("sla_breach").cast("int")).alias("breaches"),
        F.count("sla_breach").alias("breach_known"),
        F.count_if(st == "CANCELLED").alias("cancelled"),
        F.count_if(st == "RETURNED").alias("returned"),
        F.count_if(st.isin(*SHIPPED_STATUSES) & F.col("shipped_at").isNull()).alias("no_ship_ts"),
        F.count_if((st == "DELIVERED") & F.col("delivered_at").isNull()).alias("no_deliv_ts"),
        F.datediff(F.max("event_date"), F.min("event_date")).alias("span"),
        # days as a set, bounded by the calendar: a second distinct aggregate would expand every row
        F.size(F.collect_set("event_date")).alias("n_days"),
    )
    n = F.col("n")
    missing_days = F.col("span") + 1 - F.col("n_days")
    sla = _ratio(F.col("breaches"), F.col("breach_known"))
    cancel = _ratio(F.col("cancelled"), n)
    ret = _ratio(F.col("returned"), n)
    return _checks("order_events", a, [
        ("Q1", rule("row count", "at least", 1000), "error", None, n, n >= 1000),
        ("Q2", rule("order_id", "unique"), "error", n - F.col("n_ids"), None, n == F.col("n_ids")),
        ("Q3", rule("order_id", "no NULLs"), "error", F.col("null_id"), None, _zero("null_id")),
        ("Q4", rule("warehouse_id", "no NULLs"), "error", F.col("null_wh"), None, _zero("null_wh")),
        ("Q5", rule("order_status", "no NULLs"), "error", F.col("null_status"), None, _zero("null_status")),
        ("Q6", rule("placed_at", "no NULLs"), "error", F.col("null_placed"), None, _zero("null_placed")),
        ("Q7", rule("order_status", "in domain"), "error", F.col("bad_status"), None, _zero("bad_status")),
        ("Q8", rule("order_value_usd", "above", 0), "error", F.col("bad_value"), None, _zero("bad_value")),
        ("Q9", rule("units_ordered", "at least", 1), "error", F.col("bad_units"), None, _zero("bad_units")),
        ("Q10", rule("sla_breach share", "below", 0.15), "warn", None, sla, F.coalesce(sla < 0.15, F.lit(False))),
        ("Q11", rule("CANCELLED share", "between", 0.01, 0.1), "error", None, cancel,
         F.coalesce(cancel.between(0.01, 0.10), F.lit(False))),
        ("Q12", rule("RETURNED share", "between", 0.01, 0.1), "error", None, ret, F.coalesce(ret.between(0.01, 0.10), F.lit(False))),
        ("Q13", rule("shipped_at", "present once shipped"), "error", F.col("no_ship_ts"), None, _zero("no_ship_ts")),
        ("Q14", rule("delivered_at", "present once delivered"), "error", F.col("no_deliv_ts"), None, _zero("no_deliv_ts")),
        ("Q15", rule("event_date span", "at least", 28), "error", None, F.col("span"),
         F.coalesce(F.col("span") >= 28, F.lit(False))),
        # The span test alone cannot see a missing day inside the range.
        ("Q15b", rule("event_date", "no missing days"), "warn", missing_days, None, F.coalesce(missing_days == 0, F.lit(True))),
    ])


def orphan_shipments(shipments: DataFrame, orders: DataFrame) -> DataFrame:
    """Shipments whose order_id is not a shipped order (NULL order_id is an orphan)."""
    shipped = orders.where(F.col("order_status").isin(*SHIPPED_STATUSES)).select("order_id").distinct()
    return _without(shipments, shipped, "order_id")


#: Ids whose rows do not go through the shuffle of a listing: the most frequent ones.
HEAVY_IDS = 1000


def _without(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not in ``keys`` (distinct); NULL keys are not, and do not enter the join.

    The ``HEAVY_IDS`` most frequent ids (counted with partial sums, found by a
    distributed top-k) are looked up first; their verdicts, at most that many
    rows, are broadcast to their rows, which never meet in one task. Any other
    id holds less than a thousandth of all rows and goes through the anti join.
    """
    known = rows.where(F.col(key).isNotNull())
    counts = known.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    heavy = counts.orderBy(F.desc("_n"), key).limit(HEAVY_IDS).select(key)
    lost = heavy.join(keys, key, "left_anti")
    heavy_rows = known.join(F.broadcast(lost), key, "left_semi").select(*rows.columns)
    light_rows = known.join(F.broadcast(heavy), key, "left_anti").join(keys, key, "left_anti").select(*rows.columns)
    return heavy_rows.unionByName(light_rows).unionByName(rows.where(F.col(key).isNull()))


def uncovered_orders(orders: DataFrame, shipments: DataFrame) -> DataFrame:
    """Distinct shipped order ids without any shipment row.

    Both sides are reduced to distinct ids first (partial aggregation map-side),
    so an order with a huge number of shipment rows is one row per task before
    the shuffle.
    """
    shipped = orders.where(F.col("order_status").isin(*SHIPPED_STATUSES)).select("order_id").distinct()
    return shipped.join(shipments.select("order_id").distinct(), "order_id", "left_anti")


def orphan_returns(returns: DataFrame, orders: DataFrame) -> DataFrame:
    """RETURN reports whose order is not a RETURNED order."""
    returned = orders.where(F.col("order_status") == "RETURNED").select("order_id").distinct()
    return _without(returns.where(F.col("report_type") == "RETURN"), returned, "order_id")


def shipment_order_coverage(shipments: DataFrame, orders: DataFrame) -> DataFrame:
    """Q20 + Q21 in one pass: one row with ``orphans`` and ``missing``.

    Shipments are first counted per order id (partial aggregate: a hot order
    is one row per task), then one full outer join with the distinct shipped
    order ids gives both sides' unmatched rows. NULL ids never match, so a
    shipment without order id is an orphan (as in J5) and a NULL shipped id
    counts once as missing (as in J6).
    """
    per_order = shipments.groupBy("order_id").agg(F.count(F.lit(1)).alias("_rows"))
    shipped = (orders.where(F.col("order_status").isin(*SHIPPED_STATUSES)).select("order_id").distinct()
               .withColumn("_shipped", F.lit(True)))
    j = per_order.join(shipped, "order_id", "full_outer")
    return j.agg(
        F.coalesce(F.sum(F.when(F.col("_shipped").isNull(), F.col("_rows"))), F.lit(0)).alias("orphans"),
        F.count_if(F.col("_rows").isNull()).alias("missing"),
    )


def unknown_warehouses(capacity: DataFrame, expected: DataFrame) -> DataFrame:
    """Symmetric difference of the warehouse ids found and the expected set."""
    found = capacity.select("warehouse_id").distinct()
    exp = expected.select("warehouse_id").distinct()
    return (found.join(exp, "warehouse_id", "left_anti").withColumn("issue", F.lit("unexpected"))
            .unionByName(exp.join(found, "warehouse_id", "left_anti").withColumn("issue", F.lit("missing"))))


def quality_shipments(shipments: DataFrame, orders: DataFrame) -> DataFrame:
    """Q16-Q22 over raw shipments, referencing raw orders."""
    a = shipments.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_distinct("shipment_id").alias("n_ids"),
        F.count_if(F.col("carrier").isNull()).alias("null_carrier"),
        F.count_if(F.col("tracking_number").isNull()).alias("null_tracking"),
        F.sum(F.col("late_delivery").cast("int")).alias("late"),
        F.count("late_delivery").alias("late_known"),
    )
    coverage = shipment_order_coverage(shipments, orders)
    n = F.col("n")
    late = _ratio(F.col("late"), F.col("late_known"))
    refs = _checks("shipment_tracking", coverage, [
        ("Q20", rule("order_id", "refers to a shipped order"), "error", F.col("orphans"), None, _zero("orphans")),
        ("Q21", rule("shipped order_id", "has a shipment"), "warn", F.col("missing"), None, _zero("missing")),
    ])
    return refs.unionByName(_checks("shipment_tracking", a, [
        ("Q16", rule("row count", "above", 0), "error", None, n, n > 0),
        ("Q17", rule("shipment_id", "unique"), "error", n - F.col("n_ids"), None, n == F.col("n_ids")),
        ("Q18", rule("carrier", "no NULLs"), "error", F.col("null_carrier"), None, _zero("null_carrier")),
        ("Q19", rule("tracking_number", "no NULLs"), "error", F.col("null_tracking"), None, _zero("null_tracking")),
        ("Q22", rule("late_delivery share", "below", 0.15), "warn", None, late, F.coalesce(late < 0.15, F.lit(False))),
    ]))


def quality_capacity(capacity: DataFrame, expected_warehouses: DataFrame) -> DataFrame:
    """Q23-Q27 over capacity snapshots."""
    a = capacity.agg(
        _fails(F.col("utilization_pct").between(0, 100)).alias("bad_util"),
        _fails(F.col("units_processed") <= F.col("max_daily_capacity")).alias("over_cap"),
        _fails(F.col("headcount") > 0).alias("bad_headcount"),
        F.datediff(F.max("snapshot_date"), F.min("snapshot_date")).alias("span"),
    )
    diff = unknown_warehouses(capacity, expected_warehouses).agg(F.count(F.lit(1)).alias("wh_diff"))
    q23 = _checks("warehouse_capacity", diff, [
        ("Q23", rule("warehouse_id", "as expected"), "error", F.col("wh_diff"), None, _zero("wh_diff")),
    ])
    return q23.unionByName(_checks("warehouse_capacity", a, [
        ("Q24", rule("utilization_pct", "between", 0, 100), "error", F.col("bad_util"), None, _zero("bad_util")),
        ("Q25", rule("units_processed", "at most", "max_daily_capacity"), "error", F.col("over_cap"), None, _zero("over_cap")),
        ("Q26", rule("headcount", "above", 0), "error", F.col("bad_headcount"), None, _zero("bad_headcount")),
        ("Q27", rule("snapshot_date span", "at least", 28), "error", None, F.col("span"),
         F.coalesce(F.col("span") >= 28, F.lit(False))),
    ]))


def quality_returns(returns: DataFrame, orders: DataFrame) -> DataFrame:
    """Q28-Q32 over returns/defects, referencing raw orders."""
    any_null = F.greatest(*[F.col(c).isNull().cast("int") for c in returns.columns]) == 1
    a = returns.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(any_null).alias("rows_with_null"),
        F.count_distinct("record_id").alias("n_ids"),
        _fails(F.col("report_type").isin(*REPORT_TYPES)).alias("bad_type"),
        _fails(F.col("units_affected") >= 1).alias("bad_units"),
    )
    per_order = returns.where(F.col("report_type") == "RETURN").groupBy("order_id").agg(F.count(F.lit(1)).alias("_rows"))
    returned = orders.where(F.col("order_status") == "RETURNED").select("order_id").distinct()
    orphans = per_order.join(returned, "order_id", "left_anti").agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("orphans"))
    n = F.col("n")
    q32 = _checks("returns_defects", orphans, [
        ("Q32", rule("order_id", "refers to a returned order"), "error", F.col("orphans"), None, _zero("orphans")),
    ])
    return q32.unionByName(_checks("returns_defects", a, [
        ("Q28", rule("row count", "above", 0), "error", None, n, (F.col("rows_with_null") == 0) | (n > 0)),
        ("Q29", rule("record_id", "unique"), "error", n - F.col("n_ids"), None, n == F.col("n_ids")),
        ("Q30", rule("report_type", "in domain"), "error", F.col("bad_type"), None, _zero("bad_type")),
        ("Q31", rule("units_affected", "at least", 1), "error", F.col("bad_units"), None, _zero("bad_units")),
    ]))


def curated_smoke(curated: dict[str, DataFrame], keys: dict[str, Sequence[str]]) -> DataFrame:
    """Q33: per curated dataset: rows > 0, has ``ingested_at``, no NULL key."""
    parts = []
    for name in sorted(curated):
        df = curated[name]
        has_stamp = "ingested_at" in df.columns
        null_key = F.count_if(F.greatest(*[F.col(k).isNull().cast("int") for k in keys[name]]) == 1) \
            if len(keys[name]) > 1 else F.count_if(F.col(keys[name][0]).isNull())
        a = df.agg(F.count(F.lit(1)).alias("n"), null_key.alias("null_keys"))
        parts.append(_checks(name, a, [
            ("Q33a", rule("row count", "above", 0), "error", None, F.col("n"), F.col("n") > 0),
            ("Q33b", rule("ingested_at", "present"), "error", None, None, F.lit(has_stamp)),
            ("Q33c", rule("key", "no NULLs"), "error", F.col("null_keys"), None, _zero("null_keys")),
        ]))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
