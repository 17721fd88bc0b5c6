"""Registered queries: each ``(spark, sf_dir) -> DataFrame`` over the driver's tables.

Every query builds the raw datasets from the given tables (fixtures), runs
the same cleanse / star / mart operators a production run uses, and returns
the result lazily. Nondeterministic columns (``ingested_at``, hash keys) are
left out of results that are compared against the oracle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fulfilq.functions import hours_between, shift_of_hour, sla_breach
from fulfilq.operators import cleanse, dims, marts, quality
from fulfilq.operators import upsert as ups
from fulfilq.plans import pipeline
from fulfilq.plans.star import fixture_curated, fixture_star
from fulfilq.schemas import (
    DEFAULT_SLA_HOURS,
    LOAD_SEQ,
    ORDER_EVENTS,
    RETURNS_DEFECTS,
    SHIPMENT_TRACKING,
    WAREHOUSE_CAPACITY,
)
from fulfilq.session import configure, scratch_path
from fulfilq.sources import fixtures
from fulfilq.sources import storage
from fulfilq.sources.fixtures import EXPECTED_WAREHOUSE_IDS

Query = Callable[[SparkSession, str], DataFrame]


def _star(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    configure(spark)
    return fixture_star(spark, sf_dir)


def q_daily_ops_scorecard(spark, sf_dir):
    t = _star(spark, sf_dir)
    return marts.daily_ops_scorecard(t["fact_order"], t["dim_date"])


def q_shift_performance(spark, sf_dir):
    return marts.shift_performance(_star(spark, sf_dir)["fact_order"])


def q_carrier_performance(spark, sf_dir):
    return marts.carrier_performance(_star(spark, sf_dir)["fact_shipment"])


def q_defect_analysis(spark, sf_dir):
    t = _star(spark, sf_dir)
    return marts.defect_analysis(t["fact_returns_defects"], t["fact_order"])


def q_warehouse_utilization(spark, sf_dir):
    return marts.warehouse_utilization(_star(spark, sf_dir)["dim_warehouse"])


def q_executive_summary(spark, sf_dir):
    return marts.executive_summary(_star(spark, sf_dir)["fact_order"])


QUERIES: dict[str, Query] = {
    "daily_ops_scorecard": q_daily_ops_scorecard,
    "shift_performance": q_shift_performance,
    "carrier_performance": q_carrier_performance,
    "defect_analysis": q_defect_analysis,
    "warehouse_utilization": q_warehouse_utilization,
    "executive_summary": q_executive_summary,
}


# ---------------------------------------------------------------------------
# Curated datasets, dedup, derivations
# ---------------------------------------------------------------------------

UPSERT_OLD_BEFORE = "2024-01-21"  # target holds days before this ...
UPSERT_NEW_FROM = "2024-01-15"    # ... the batch holds days from this one (overlap = updates)
INCREMENTAL_WATERMARK = "2024-01-15"


def _curated(spark, sf_dir, name):
    configure(spark)
    return fixture_curated(spark, sf_dir)[name]


def q_curated_orders(spark, sf_dir):
    return _curated(spark, sf_dir, "order_events")


def q_curated_shipments(spark, sf_dir):
    return _curated(spark, sf_dir, "shipment_tracking")


def q_curated_returns(spark, sf_dir):
    return _curated(spark, sf_dir, "returns_defects")


def q_warehouse_scd2(spark, sf_dir):
    return _curated(spark, sf_dir, "warehouse_capacity")


def _raw_typed(spark, sf_dir, name):
    configure(spark)
    raw = fixtures.raw_datasets(spark, sf_dir)[name]
    schema = {"order_events": ORDER_EVENTS, "shipment_tracking": SHIPMENT_TRACKING,
              "warehouse_capacity": WAREHOUSE_CAPACITY, "returns_defects": RETURNS_DEFECTS}[name]
    return cleanse.cast_columns(raw, schema)


def q_dedup_orders(spark, sf_dir):
    return cleanse.dedup_latest(_raw_typed(spark, sf_dir, "order_events"), ["order_id"], "placed_at")


def q_dedup_shipments(spark, sf_dir):
    return cleanse.dedup_latest(_raw_typed(spark, sf_dir, "shipment_tracking"), ["shipment_id"], "shipped_at")


def q_dedup_returns(spark, sf_dir):
    return cleanse.dedup_latest(_raw_typed(spark, sf_dir, "returns_defects"), ["record_id"], "reported_at")


def q_null_audit_orders(spark, sf_dir):
    cols = ["order_id", "warehouse_id", "product_category", "order_status", "placed_at", "order_value_usd"]
    return cleanse.null_counts(_raw_typed(spark, sf_dir, "order_events"), cols)


def q_incremental_orders(spark, sf_dir):
    """S3: only events on/after the watermark day enter the cleanse."""
    raw = _raw_typed(spark, sf_dir, "order_events")
    return cleanse.cleanse_orders(raw.where(F.col("event_date") >= F.lit(INCREMENTAL_WATERMARK).cast("date")),
                                  stamp=False)


def q_sla_breach_recomputed(spark, sf_dir):
    """J8 + F11: SLA hours by category (broadcast seed dimension, default 48) and the breach rule."""
    o = _curated(spark, sf_dir, "order_events")
    cat = F.broadcast(dims.dim_product_category(spark).select(
        F.col("category_name").alias("product_category"), "sla_hours"))
    j = o.join(cat, "product_category", "left")
    sla = F.coalesce(F.col("sla_hours"), F.lit(DEFAULT_SLA_HOURS))
    return j.select(
        "order_id", "product_category", sla.alias("sla_hours"),
        sla_breach("placed_at", "shipped_at", sla).alias("sla_breach_recomputed"),
        F.col("sla_breach").alias("sla_breach_stored"),
    )


def q_shift_bucket(spark, sf_dir):
    """shift from the hour the order was placed."""
    o = _curated(spark, sf_dir, "order_events")
    return o.select("order_id", F.hour("placed_at").alias("placed_hour"),
                    shift_of_hour("placed_at").alias("shift_recomputed"), F.col("shift").alias("shift_stored"))


def q_processing_hours(spark, sf_dir):
    """(shipped - placed) hours, 2 digits; NULL when not shipped."""
    o = _curated(spark, sf_dir, "order_events")
    return o.select("order_id", hours_between("shipped_at", "placed_at").cast("double")
                    .alias("processing_hours_recomputed"), F.col("processing_hours").alias("processing_hours_stored"))


def q_late_flag(spark, sf_dir):
    """late = actual delivery after the estimate; undelivered is not late."""
    s = _curated(spark, sf_dir, "shipment_tracking")
    late = F.coalesce(F.col("actual_delivery_at") > F.col("estimated_delivery_at"), F.lit(False))
    return s.select("shipment_id", late.alias("late_recomputed"), F.col("late_delivery").alias("late_stored"))


def q_delivery_delay(spark, sf_dir):
    """delay hours per carrier and status (sum and count of known delays)."""
    s = _curated(spark, sf_dir, "shipment_tracking")
    return s.groupBy("carrier", "delivery_status").agg(
        F.count(F.lit(1)).alias("shipments"),
        F.count("delivery_delay_hours").alias("with_delay"),
        F.round(F.sum(F.col("delivery_delay_hours").cast("decimal(12,2)")), 2).cast("double").alias("delay_hours_sum"),
        F.min("delivery_delay_hours").alias("min_delay_hours"),
        F.max("delivery_delay_hours").alias("max_delay_hours"),
    )


# ---------------------------------------------------------------------------
# Referential checks and the quality suite
# ---------------------------------------------------------------------------
def q_orphan_shipments(spark, sf_dir):
    sh = _raw_typed(spark, sf_dir, "shipment_tracking")
    return quality.orphan_shipments(sh, _raw_typed(spark, sf_dir, "order_events")).select("shipment_id", "order_id")


def q_uncovered_orders(spark, sf_dir):
    return quality.uncovered_orders(_raw_typed(spark, sf_dir, "order_events"),
                                    _raw_typed(spark, sf_dir, "shipment_tracking"))


def q_orphan_returns(spark, sf_dir):
    r = _raw_typed(spark, sf_dir, "returns_defects")
    return quality.orphan_returns(r, _raw_typed(spark, sf_dir, "order_events")).select("record_id", "order_id")


def _expected_warehouses(spark):
    return spark.createDataFrame([(w,) for w in EXPECTED_WAREHOUSE_IDS], "warehouse_id string")


def q_unknown_warehouses(spark, sf_dir):
    return quality.unknown_warehouses(_raw_typed(spark, sf_dir, "warehouse_capacity"), _expected_warehouses(spark))


def q_quality_orders(spark, sf_dir):
    return quality.quality_orders(_raw_typed(spark, sf_dir, "order_events"))


def q_quality_shipments(spark, sf_dir):
    return quality.quality_shipments(_raw_typed(spark, sf_dir, "shipment_tracking"),
                                     _raw_typed(spark, sf_dir, "order_events"))


def q_quality_capacity(spark, sf_dir):
    return quality.quality_capacity(_raw_typed(spark, sf_dir, "warehouse_capacity"), _expected_warehouses(spark))


def q_quality_returns(spark, sf_dir):
    return quality.quality_returns(_raw_typed(spark, sf_dir, "returns_defects"),
                                   _raw_typed(spark, sf_dir, "order_events"))


def q_curated_smoke(spark, sf_dir):
    configure(spark)
    cur = fixture_curated(spark, sf_dir, stamp=True)
    keys = {"order_events": ["order_id"], "shipment_tracking": ["shipment_id"],
            "warehouse_capacity": ["warehouse_id", "effective_start_date"], "returns_defects": ["record_id"]}
    return quality.curated_smoke(cur, keys)


# ---------------------------------------------------------------------------
# Upserts (S9a-d) on an old/new split of the fixture
# ---------------------------------------------------------------------------
def _snapshot(spark, sf_dir, name):
    """The curated dataset both sides of an upsert scenario come from, computed once.

    Old target and new batch are two filters of it; without the copy
    each branch would re-run the dedup window (filters on the date cannot
    move below a window partitioned by the business key). It is Parquet in the
    shared checkpoint folder, so each branch reads its columns and days only.
    """
    return storage.materialize(spark, _curated(spark, sf_dir, name), "snapshot")


def _split(df, date_col):
    d = F.col(date_col)
    old = df.where(d < F.lit(UPSERT_OLD_BEFORE).cast("date"))
    new = df.where(d >= F.lit(UPSERT_NEW_FROM).cast("date"))
    stale = d >= F.lit(UPSERT_NEW_FROM).cast("date")
    return old, new, stale


def q_upsert_orders(spark, sf_dir):
    cur = _snapshot(spark, sf_dir, "order_events")
    old, new, stale = _split(cur, "event_date")
    old = old.withColumn("order_status", F.when(stale, F.lit("PLACED")).otherwise(F.col("order_status")))
    return ups.upsert(old, new, ["order_id"])


def q_upsert_shipments(spark, sf_dir):
    cur = _snapshot(spark, sf_dir, "shipment_tracking")
    old, new, stale = _split(cur, "event_date")
    old = old.withColumn("late_delivery", F.when(stale, ~F.col("late_delivery")).otherwise(F.col("late_delivery")))
    return ups.upsert(old, new, ["shipment_id"])


def q_upsert_returns(spark, sf_dir):
    cur = _snapshot(spark, sf_dir, "returns_defects")
    old, new, stale = _split(cur, "event_date")
    old = old.withColumn("refund_issued", F.when(stale, ~F.col("refund_issued")).otherwise(F.col("refund_issued")))
    return ups.upsert(old, new, ["record_id"])


def q_upsert_warehouse(spark, sf_dir):
    """S9c + X21: the old history's last versions are re-closed by the new snapshots."""
    snaps = cleanse.cast_columns(_raw_typed(spark, sf_dir, "warehouse_capacity"), WAREHOUSE_CAPACITY)
    old, new, _ = _split(snaps, "snapshot_date")
    history = cleanse.scd2_versions(old)
    return ups.upsert_scd2(history, new)


# ---------------------------------------------------------------------------
# Row counts, status mix, dimensions in use
# ---------------------------------------------------------------------------
def q_table_row_counts(spark, sf_dir):
    t = _star(spark, sf_dir)
    return marts.table_row_counts({k: t[k] for k in (
        "fact_order", "fact_shipment", "dim_warehouse", "fact_returns_defects", "dim_date", "dim_carrier",
        "dim_product_category")})


def q_order_status_mix(spark, sf_dir):
    return marts.order_status_mix(_raw_typed(spark, sf_dir, "order_events"))


def q_calendar_coverage(spark, sf_dir):
    """D1 + X24: every calendar day between the first and last order day, with its order count."""
    o = _star(spark, sf_dir)["fact_order"]
    span = o.agg(F.min("event_date").alias("lo"), F.max("event_date").alias("hi"))
    days = span.select(F.explode(F.sequence("lo", "hi", F.expr("interval 1 day"))).alias("full_date"))
    cal = dims.dim_date_of(days)
    per_day = o.groupBy("event_date").agg(F.count(F.lit(1)).alias("orders"))
    j = cal.join(per_day, cal["full_date"] == per_day["event_date"], "left")
    return j.select(*cal.columns, F.coalesce(F.col("orders"), F.lit(0)).alias("orders"))


def q_carrier_type_mix(spark, sf_dir):
    """Shipments per carrier type via the (broadcast) carrier dimension."""
    s = _star(spark, sf_dir)["fact_shipment"]
    c = F.broadcast(dims.dim_carrier(spark).select(F.col("carrier_name").alias("carrier"), "carrier_type"))
    j = s.join(c, "carrier", "left")
    return j.groupBy("carrier_type").agg(F.count(F.lit(1)).alias("shipments"),
                                        F.count_if(F.col("late_delivery")).alias("late_shipments"))


QUERIES.update({
    "table_row_counts": q_table_row_counts,
    "order_status_mix": q_order_status_mix,
    "curated_orders": q_curated_orders,
    "curated_shipments": q_curated_shipments,
    "curated_returns": q_curated_returns,
    "warehouse_scd2": q_warehouse_scd2,
    "dedup_orders": q_dedup_orders,
    "dedup_shipments": q_dedup_shipments,
    "dedup_returns": q_dedup_returns,
    "calendar_coverage": q_calendar_coverage,
    "carrier_type_mix": q_carrier_type_mix,
    "upsert_orders": q_upsert_orders,
    "upsert_shipments": q_upsert_shipments,
    "upsert_warehouse": q_upsert_warehouse,
    "upsert_returns": q_upsert_returns,
    "incremental_orders": q_incremental_orders,
    "sla_breach_recomputed": q_sla_breach_recomputed,
    "shift_bucket": q_shift_bucket,
    "late_flag": q_late_flag,
    "processing_hours": q_processing_hours,
    "delivery_delay": q_delivery_delay,
    "orphan_shipments": q_orphan_shipments,
    "uncovered_orders": q_uncovered_orders,
    "orphan_returns": q_orphan_returns,
    "unknown_warehouses": q_unknown_warehouses,
    "null_audit_orders": q_null_audit_orders,
    "quality_orders": q_quality_orders,
    "quality_shipments": q_quality_shipments,
    "quality_capacity": q_quality_capacity,
    "quality_returns": q_quality_returns,
    "curated_smoke": q_curated_smoke,
})


# ---------------------------------------------------------------------------
# End to end through storage: land -> cleanse -> upsert -> audit
# ---------------------------------------------------------------------------
def q_pipeline_audit(spark, sf_dir):
    """Run the batch pipeline into a fresh folder under the shared checkpoint dir; return its audit rows.

    The audit log holds one row per target table (bounded metadata), so it is
    kept as a small DataFrame and the pipeline's folder is removed.
    """
    configure(spark)
    root = scratch_path(spark, "pipeline")
    layout = pipeline.Layout(f"{root}/raw", f"{root}/curated", f"{root}/warehouse")
    pipeline.land(spark, layout, fixtures.raw_datasets(spark, sf_dir))
    pipeline.run_cleanse(spark, layout)
    storage.remove(spark, layout.landing)  # the load reads the curated files only
    pipeline.run_load(spark, layout)
    audit_rows = spark.read.parquet(layout.audit).select(
        "job_name", "target_table", "rows_loaded", "run_status", "watermark_date")
    result = spark.createDataFrame(audit_rows.collect(), audit_rows.schema)
    storage.remove(spark, root)
    return result


QUERIES["pipeline_audit"] = q_pipeline_audit


# ---------------------------------------------------------------------------
# Stored tables: what two batches leave behind (S9a, S9b), marks (T1, T2), landed text
# ---------------------------------------------------------------------------
BATCH_CUT = "2024-01-15"  # the first batch holds the days up to this one


def _stored_upsert(spark, table, rows, keys, latest_by, roles, before):
    """The stored table after two batches; ``rows`` is what must be left.

    ``roles`` marks rows by column predicates: ``undated`` rows have no event
    date; ``moved`` keys come first as an older record of another day; ``stale``
    records come again, older, with the second batch; ``twice`` keys are in the
    second batch twice; ``tie`` records come first with the values of ``before``
    and the same time, and then as they are: the later arrival wins.
    """
    configure(spark)
    # both batches are unions of filters of it, which cannot move below its dedup: it is computed once
    rows = storage.materialize(spark, rows.drop("ingested_at"), "snapshot")
    early = F.col("event_date") <= F.lit(BATCH_CUT).cast("date")
    dated = F.when(~roles["undated"], F.col("event_date"))

    def older(df, hours, day_back=0):
        at = F.timestamp_seconds(F.unix_timestamp(latest_by) - 3600 * hours)
        return df.withColumns({latest_by: at, "event_date": F.date_sub("event_date", day_back)})

    tie = roles["tie"]
    first = rows.where(early).withColumn("event_date", dated).withColumns(
        {c: F.when(tie, v.cast(rows.schema[c].dataType)).otherwise(F.col(c)) for c, v in before.items()})
    first = first.unionByName(older(rows.where(~early & roles["moved"]), 24, 1))
    second = rows.where(~early).withColumn("event_date", dated).unionByName(
        rows.where(early & tie).withColumn("event_date", dated))
    second = second.unionByName(older(rows.where(early & roles["stale"]), 1))
    second = second.unionByName(older(rows.where(~early & roles["twice"]), 2))
    path = scratch_path(spark, f"stored-{table}")
    for batch in (first, second):
        pipeline.upsert_table(spark, path, batch, keys, True, latest_by=latest_by)
    storage.remove(spark, rows._scratch_path)
    doubles = {c: F.col(c).cast("double") for c, t in rows.dtypes if t.startswith("decimal")}
    return storage.read_curated(spark, path).withColumns(doubles).select(*rows.columns[1:])


def q_stored_upsert_orders(spark, sf_dir):
    u = F.col("units_ordered")
    roles = {"undated": u == 5, "moved": u == 3, "stale": u == 2, "twice": u == 4, "tie": u.isin(6, 7, 8)}
    # statuses before and after in the alphabet, a greater and a smaller value than the later arrival's
    before = {"order_status": F.when(u == 6, F.lit("A")).otherwise(F.lit("ZZ")),
              "order_value_usd": F.col("order_value_usd") + F.when(u == 7, F.lit(10)).otherwise(F.lit(-1))}
    return _stored_upsert(spark, "orders", _star(spark, sf_dir)["fact_order"], ["order_id"], "placed_at", roles, before)


def q_stored_upsert_shipments(spark, sf_dir):
    c = F.col("carrier")
    roles = {"undated": c == "OnTrac", "moved": c == "FedEx", "stale": c == "UPS", "twice": c == "USPS", "tie": c == "Amazon Logistics"}
    before = {"late_delivery": ~F.col("late_delivery"), "delivery_status": F.lit("SHIPPED"), "actual_delivery_at": F.lit(None)}
    return _stored_upsert(spark, "shipments", _star(spark, sf_dir)["fact_shipment"], ["shipment_id"], "shipped_at", roles, before)


def q_stored_upsert_returns(spark, sf_dir):
    u = F.col("units_affected")
    roles = {"undated": u == 5, "moved": u == 3, "stale": u == 2, "twice": u == 4, "tie": u.isin(1, 6)}
    before = {"refund_issued": ~F.col("refund_issued"), "units_affected": u + 9, "defect_type": F.lit(None)}
    return _stored_upsert(spark, "returns", _star(spark, sf_dir)["fact_returns_defects"], ["record_id"], "reported_at", roles, before)


def q_watermark_advance(spark, sf_dir):
    """Each target's mark after a first run over the early days and after an ``auto`` run over all, with its rows."""
    from fulfilq.operators import audit

    configure(spark)
    root = scratch_path(spark, "marks")
    layout = pipeline.Layout(f"{root}/raw", f"{root}/curated", f"{root}/warehouse")
    names = ("order_events", "shipment_tracking")
    raw = {n: fixtures.raw_datasets(spark, sf_dir)[n] for n in names}
    early = F.col("event_date") <= F.lit(BATCH_CUT).cast("date")
    targets = [pipeline.TARGETS[n][0] for n in names]
    marks = []
    for part in ({n: df.where(early) for n, df in raw.items()}, raw):
        pipeline.land(spark, layout, part)
        since = audit.resolve_watermarks(spark, layout.audit, targets)
        pipeline.run_cleanse(spark, layout, since)
        pipeline.run_load(spark, layout, since)
        marks.append(audit.resolve_watermarks(spark, layout.audit, targets))
    for done in (layout.landing, layout.curated):  # the result reads the tables only
        storage.remove(spark, done)
    parts = [
        storage.read_curated(spark, layout.table(t)).agg(
            F.lit(t).alias("target_table"), F.lit(marks[0][t]).cast("date").alias("first_mark"),
            F.lit(marks[1][t]).cast("date").alias("second_mark"), F.count(F.lit(1)).alias("row_count"))
        for t in targets
    ]
    return parts[0].unionByName(parts[1])


def q_landed_orders(spark, sf_dir):
    """S1 + P1-P3: orders landed as CSV text, some of it malformed, read back by header and cast."""
    configure(spark)
    raw = fixtures.raw_datasets(spark, sf_dir)["order_events"]
    u = F.col("units_ordered")
    text = raw.select(*[F.col(c).cast("string").alias(c) for c in raw.columns]).withColumns({
        "placed_at": F.when(u == 3, F.lit("2024-13-45 99:00")).otherwise(F.col("placed_at").cast("string")),
        "prime_member": F.when(u == 2, F.lit("perhaps")).otherwise(F.col("prime_member").cast("string")),
        "order_value_usd": F.when(u == 6, F.lit("12,x")).otherwise(F.col("order_value_usd").cast("string")),
        "units_ordered": F.when(u == 7, F.lit("many")).otherwise(u.cast("string")),
    })
    path = f"{scratch_path(spark, 'landed')}/order_events"
    storage.write_landing(text, path)
    return cleanse.cast_columns(storage.read_landing(spark, path, ORDER_EVENTS).drop(LOAD_SEQ), ORDER_EVENTS)


def q_landed_returns(spark, sf_dir):
    """Returns landed in two files with unlike headers, read back by name.

    The first has its columns in reverse order and lacks the root cause, the
    second has one column more.
    """
    configure(spark)
    raw = fixtures.raw_datasets(spark, sf_dir)["returns_defects"]
    path = f"{scratch_path(spark, 'landed')}/returns_defects"
    first = raw.where(F.col("report_type").eqNullSafe("RETURN")).select(*raw.columns[::-1]).drop("root_cause_category")
    second = raw.where(~F.col("report_type").eqNullSafe("RETURN")).withColumn("inspector", F.lit("x"))
    for name, part in (("first", first), ("second", second)):
        storage.write_landing(part, f"{path}/{name}", partitioned=False)
    return cleanse.cast_columns(storage.read_landing(spark, path, RETURNS_DEFECTS, False).drop(LOAD_SEQ), RETURNS_DEFECTS)


def q_curated_rerun(spark, sf_dir):
    """Curated orders after two full runs; keys moved to another day in between, and a day has no rows any more."""
    configure(spark)
    root = scratch_path(spark, "rerun")
    raw = fixtures.raw_datasets(spark, sf_dir)["order_events"]
    u = F.col("units_ordered")
    day = F.when(u == 8, F.lit("2023-12-31").cast("date")).when(u == 3, F.date_add("event_date", 1)).otherwise(F.col("event_date"))
    for i, landed in enumerate((raw.withColumn("event_date", day), raw)):
        layout = pipeline.Layout(f"{root}/raw{i}", f"{root}/curated", f"{root}/warehouse")
        pipeline.land(spark, layout, {"order_events": landed})
        pipeline.run_cleanse(spark, layout)
    return storage.read_curated(spark, layout.cur("order_events")).drop(LOAD_SEQ, "ingested_at")


def _cleansed(spark, sf_dir):
    """The four datasets landed and cleansed through files; (layout, what ``run_cleanse`` reports)."""
    configure(spark)
    root = scratch_path(spark, "cleansed")
    layout = pipeline.Layout(f"{root}/raw", f"{root}/curated", f"{root}/warehouse")
    pipeline.land(spark, layout, fixtures.raw_datasets(spark, sf_dir))
    got = pipeline.run_cleanse(spark, layout)
    storage.remove(spark, layout.landing)  # what comes later reads the curated files only
    return layout, got


def q_curated_files_smoke(spark, sf_dir):
    """Q33 over the curated files of a run (S6, S13: two of them flat)."""
    return pipeline.smoke(spark, _cleansed(spark, sf_dir)[0])


def q_cleanse_counts(spark, sf_dir):
    """S16 + A15: rows read, kept and removed per dataset, as the run reports them (one row per dataset)."""
    layout, got = _cleansed(spark, sf_dir)
    storage.remove(spark, layout.curated)  # the counts are all that is returned
    rows = [(n, r["raw_rows"], r["rows"], r["removed"]) for n, r in got.items()]
    return spark.createDataFrame(rows, "dataset string, raw_rows bigint, curated_rows bigint, removed_rows bigint")


def q_calendar_orders(spark, sf_dir):
    """The whole calendar, with the orders of each day."""
    o = _star(spark, sf_dir)["fact_order"]
    per_day = o.groupBy("event_date").agg(F.count(F.lit(1)).alias("orders"))
    cal = dims.dim_date(spark)
    j = cal.join(per_day, cal["full_date"] == per_day["event_date"], "left")
    return j.select(*cal.columns, F.coalesce(F.col("orders"), F.lit(0)).alias("orders"))


def q_carrier_ranking(spark, sf_dir):
    """O1: the carrier mart in the order it is presented, with each row's position."""
    m = marts.carrier_performance(_star(spark, sf_dir)["fact_shipment"])
    # a mart is an aggregate of days x carriers, so it may be numbered in one task
    w = Window.orderBy(*marts.presentation_columns("carrier_performance"), "carrier")
    return m.select("event_date", "carrier", "on_time_rate_pct", F.row_number().over(w).cast("bigint").alias("position"))


def q_view_scorecard(spark, sf_dir):
    """The registered views queried with SQL."""
    t = _star(spark, sf_dir)
    star = {n: t[n] for n in ("fact_order", "dim_date")}
    pipeline.register_views(star, {"daily_ops_scorecard": marts.daily_ops_scorecard(t["fact_order"], t["dim_date"])})
    return spark.sql("""
        SELECT f.warehouse_id, COUNT(*) AS days, MAX(v.total_orders) AS most_orders, SUM(f.orders) AS orders
        FROM v_daily_ops_scorecard v
        JOIN (SELECT event_date, warehouse_id, COUNT(*) AS orders FROM fact_order GROUP BY event_date, warehouse_id) f
          ON f.event_date = v.event_date AND f.warehouse_id = v.warehouse_id
        GROUP BY f.warehouse_id""")


QUERIES.update({
    "stored_upsert_returns": q_stored_upsert_returns,
    "landed_returns": q_landed_returns,
    "curated_rerun": q_curated_rerun,
    "curated_files_smoke": q_curated_files_smoke,
    "cleanse_counts": q_cleanse_counts,
    "calendar_orders": q_calendar_orders,
    "carrier_ranking": q_carrier_ranking,
    "view_scorecard": q_view_scorecard,
})


QUERIES.update({
    "stored_upsert_orders": q_stored_upsert_orders,
    "stored_upsert_shipments": q_stored_upsert_shipments,
    "watermark_advance": q_watermark_advance,
    "landed_orders": q_landed_orders,
})
