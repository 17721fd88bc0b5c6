"""End-to-end: land fixture CSV, cleanse to curated Parquet, upsert into star tables, build marts."""

import os

from pyspark.sql import functions as F

from fulfilq.operators import audit, marts
from fulfilq.plans import pipeline
from fulfilq.plans.star import fixture_star
from fulfilq.sources import fixtures

SF = "/root/testdata/sf0.001"


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_pipeline_end_to_end_matches_lazy_plan_and_is_idempotent(spark, tmp_root):
    layout = pipeline.Layout(landing=f"{tmp_root}/raw", curated=f"{tmp_root}/curated",
                             warehouse=f"{tmp_root}/wh")
    pipeline.land(spark, layout, fixtures.raw_datasets(spark, SF))
    assert os.path.isdir(f"{tmp_root}/raw/order_events/date=2024-01-05")

    counts = pipeline.run_cleanse(spark, layout)
    n_orders = fixtures.order_events(spark, SF).count()
    raw_orders = fixtures.raw_datasets(spark, SF)["order_events"].count()
    got = counts["order_events"]
    assert (got["raw_rows"], got["rows"], got["removed"]) == (raw_orders, n_orders, raw_orders - n_orders)
    raw_status = fixtures.raw_datasets(spark, SF)["order_events"].where("order_status is null").count()
    assert got["nulls"]["order_status"] == raw_status > 0 and got["nulls"]["order_id"] == 0
    pipeline.run_load(spark, layout)
    star = pipeline.load_star(spark, layout)
    lazy = fixture_star(spark, SF)
    for t in ("fact_order", "fact_shipment", "fact_returns_defects", "dim_warehouse"):
        assert star[t].count() == lazy[t].count(), t
    m_disk = pipeline.build_marts(star)
    m_mem = marts.daily_ops_scorecard(lazy["fact_order"], lazy["dim_date"])
    assert _rows(m_disk["daily_ops_scorecard"]) == _rows(m_mem)
    before = _rows(star["fact_order"].drop("ingested_at"))

    # second identical run: same tables (upsert is idempotent), audit grows by one row per target
    pipeline.run_cleanse(spark, layout)
    pipeline.run_load(spark, layout)
    star2 = pipeline.load_star(spark, layout)
    assert _rows(star2["fact_order"].drop("ingested_at")) == before
    log = spark.read.parquet(layout.audit)
    assert log.count() == 8
    # the flat datasets' files did not change: nothing to load
    skipped = {r["target_table"] for r in log.where(F.col("run_status") != "SUCCESS").collect()}
    assert skipped == {"dim_warehouse", "fact_returns_defects"}
    wm = {r.target_table: r.next_watermark for r in audit.next_watermark(log).collect()}
    assert str(wm["fact_order"]) == "2024-01-30" and wm["dim_warehouse"] is None


def test_incremental_run_keeps_old_partitions(spark, tmp_root):
    layout = pipeline.Layout(landing=f"{tmp_root}/raw", curated=f"{tmp_root}/curated",
                             warehouse=f"{tmp_root}/wh")
    raw = fixtures.raw_datasets(spark, SF)
    pipeline.land(spark, layout, {"order_events": raw["order_events"]})
    # orders only: a full cleanse, then an incremental one from Jan 20
    from fulfilq.operators import cleanse
    from fulfilq.schemas import ORDERS_SPEC
    from fulfilq.sources import storage

    def cleanse_orders(wm):
        df = storage.read_landing(spark, layout.raw("order_events"), ORDERS_SPEC.schema, True, wm)
        storage.write_partitioned(cleanse.cleanse_orders(df), layout.cur("order_events"), ORDERS_SPEC.keys)

    cleanse_orders(None)
    n_all = spark.read.parquet(layout.cur("order_events")).count()
    inc = storage.read_landing(spark, layout.raw("order_events"), ORDERS_SPEC.schema, True, "2024-01-20")
    assert "PartitionFilters: [isnotnull(date" in inc._jdf.queryExecution().executedPlan().toString()
    cleanse_orders("2024-01-20")
    cur = spark.read.parquet(layout.cur("order_events"))
    assert cur.count() == n_all                       # dynamic overwrite: older days survive (X4)
    assert cur.where(F.col("event_date") < "2024-01-20").count() > 0


def test_resolve_watermarks_per_target(spark, tmp_root):
    import datetime as dt

    path, targets = f"{tmp_root}/audit", ["fact_order", "fact_shipment"]
    none = {"fact_order": None, "fact_shipment": None}
    assert audit.resolve_watermarks(spark, path, targets) == none           # a first run loads everything
    back = (dt.date.today() - dt.timedelta(days=30)).isoformat()
    assert audit.resolve_watermarks(spark, path, targets, lookback_days=30) == dict.fromkeys(targets, back)
    audit.append_audit(spark, path, [
        {"job_name": "j", "target_table": "fact_order", "rows_loaded": 5, "run_status": "SUCCESS",
         "watermark_date": dt.date(2024, 1, 20)},
        {"job_name": "j", "target_table": "fact_shipment", "rows_loaded": None, "run_status": "FAILED",
         "watermark_date": dt.date(2024, 1, 25)},
    ])
    assert audit.resolve_watermarks(spark, path, targets) == {"fact_order": "2024-01-20", "fact_shipment": None}
    assert audit.resolve_watermarks(spark, path, targets, overlap_days=3)["fact_order"] == "2024-01-17"


def test_interrupted_swap_is_recovered(spark, tmp_root):
    from fulfilq.sources import storage

    target = f"{tmp_root}/t"
    spark.range(3).write.parquet(target)
    storage.swap_in(spark, _written(spark, f"{tmp_root}/n1", 5), target)
    assert spark.read.parquet(target).count() == 5
    # crash after moving the old copy aside, before the new one arrived
    os.rename(target, target + ".old-swap")
    storage.recover_swap(spark, target)
    assert spark.read.parquet(target).count() == 5 and not os.path.exists(target + ".old-swap")


def _written(spark, path, n):
    spark.range(n).write.parquet(path)
    return path


def test_cli_validate_and_run(spark, tmp_root):
    from fulfilq.__main__ import main
    from fulfilq.sources.fixtures import FIXTURE_WAREHOUSE_IDS

    layout = pipeline.Layout(landing=f"{tmp_root}/raw", curated=f"{tmp_root}/cur", warehouse=f"{tmp_root}/wh")
    pipeline.land(spark, layout, fixtures.raw_datasets(spark, SF))
    common = ["--landing", layout.landing, "--curated", layout.curated, "--warehouse", layout.warehouse,
              "--expected-warehouses", ",".join(FIXTURE_WAREHOUSE_IDS)]
    # the fixture's raw data has duplicate ids and orphans by design: validation must fail
    assert main(["validate", *common]) == 1
    checks = {r.check_id: r for r in pipeline.validate(spark, layout, FIXTURE_WAREHOUSE_IDS).collect()}
    assert checks["Q2"].passed is False and checks["Q23"].passed is True and checks["Q1"].passed is True
    assert main(["run", *common, "--out", f"{tmp_root}/marts"]) == 0
    assert spark.read.parquet(f"{tmp_root}/marts/executive_summary").count() == 1


def test_views_are_queryable_with_sql(spark):
    star = fixture_star(spark, SF)
    m = pipeline.build_marts(star)
    pipeline.register_views({k: star[k] for k in ("fact_order", "dim_date")}, m)
    top = spark.sql("SELECT event_date, warehouse_id FROM v_daily_ops_scorecard "
                    "ORDER BY event_date DESC NULLS FIRST, warehouse_id LIMIT 1").first()
    assert str(top.event_date) == "2024-01-30"
    n = spark.sql("SELECT total_orders FROM v_executive_summary").first()[0]
    assert n == spark.sql("SELECT COUNT(*) FROM fact_order").first()[0] == 1500


def test_cleanse_skips_missing_and_empty_inputs(spark, tmp_root):
    layout = pipeline.Layout(landing=f"{tmp_root}/raw", curated=f"{tmp_root}/cur", warehouse=f"{tmp_root}/wh")
    pipeline.land(spark, layout, {"order_events": fixtures.raw_datasets(spark, SF)["order_events"]})
    got = pipeline.run_cleanse(spark, layout, watermark="2030-01-01")   # nothing that new
    assert got == {"order_events": None, "shipment_tracking": None, "warehouse_capacity": None,
                   "returns_defects": None}
    got = pipeline.run_cleanse(spark, layout)
    assert got["order_events"]["rows"] == 1500 and got["shipment_tracking"] is None
    loaded = pipeline.run_load(spark, layout)
    assert loaded == {"fact_order": 1500, "fact_shipment": None, "dim_warehouse": None,
                      "fact_returns_defects": None}
    status = {r.target_table: r.run_status for r in spark.read.parquet(layout.audit).collect()}
    assert status == {"fact_order": "SUCCESS", "fact_shipment": "SKIPPED", "dim_warehouse": "SKIPPED",
                      "fact_returns_defects": "SKIPPED"}


def test_shuffle_sizing_scales_with_input_and_is_undone(spark):
    from fulfilq.session import sized_shuffles

    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    before = spark.conf.get(key, None)
    base = int(before or spark.conf.get("spark.sql.shuffle.partitions"))
    with sized_shuffles(spark, 10 * 1024 * 1024) as n:
        assert n == base
    with sized_shuffles(spark, 100 * 1024 ** 4) as n:              # 100 TB / 256 MB
        assert n == 409600 and spark.conf.get(key) == "409600"
    assert spark.conf.get(key, None) == before


def test_cut_lineage_writes_to_the_shared_checkpoint_dir(spark):
    from fulfilq.session import checkpoint_dir, cut_lineage

    base = checkpoint_dir(spark)
    df = cut_lineage(spark.range(100).selectExpr("id", "id * 2 AS twice"))
    assert df.count() == 100
    assert "ExistingRDD" in df._jdf.queryExecution().executedPlan().toString()
    ckpt = spark.sparkContext.getCheckpointDir()
    assert ckpt is not None and base.rstrip("/").split(":")[-1] in ckpt
