"""What a run leaves on disk: no shuffle files of finished jobs, compressed landings (literal frames)."""

import os
import time

from pyspark.sql import functions as F

from fulfilq.operators import upsert as ups
from fulfilq.plans import pipeline, queries
from fulfilq.schemas import GONE, LOAD_SEQ, ORDER_EVENTS
from fulfilq.session import _FILE_CLEANUP, checkpoint_dir, released_shuffles
from fulfilq.sources import storage


def raw_orders(spark, n=2000):
    """Typed raw orders over ten days, ids that come twice, some without a day."""
    i, day = F.col("id"), F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 10).cast("int"))
    at = F.timestamp_seconds(F.unix_date(day) * 86400 + i)
    row = {"order_id": F.concat(F.lit("O-"), (i % (n - 7)).cast("string")), "warehouse_id": F.lit("FC_00"), "order_status": F.lit("DELIVERED"),
           "placed_at": at, "event_date": F.when(i % 100 != 0, day)}
    return spark.range(0, n, 1, 4).select(*[row.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in ORDER_EVENTS])


def shuffle_files(spark):
    """Names of the shuffle files that hold more than the one row of an ``isEmpty``."""
    dirs = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    found = [f"{d}/{f}" for top in dirs for d, _, names in os.walk(top.getPath()) for f in names if f.startswith("shuffle_")]
    return {os.path.basename(f) for f in found if os.path.exists(f) and os.path.getsize(f) > 1000}


def left_by(spark, step):
    """Shuffle files that the step made and that are still there (they go in the background)."""
    before = shuffle_files(spark)
    step()
    end = time.time() + 10
    while (left := shuffle_files(spark) - before) and time.time() < end:
        time.sleep(0.2)
    return left


def test_no_step_keeps_the_shuffle_files_of_its_jobs(spark, tmp_root):
    layout = pipeline.Layout(f"{tmp_root}/raw", f"{tmp_root}/cur", f"{tmp_root}/wh")
    raw = raw_orders(spark)
    assert not left_by(spark, lambda: pipeline.land(spark, layout, {"order_events": raw}))
    assert not left_by(spark, lambda: pipeline.run_cleanse(spark, layout))
    assert not left_by(spark, lambda: pipeline.run_load(spark, layout))
    stored = spark.read.parquet(layout.table("fact_order")).drop("ingested_at")
    again = storage.materialize(spark, stored, "again").where(F.col("order_id") < "O-5")
    assert not left_by(spark, lambda: pipeline.upsert_table(
        spark, layout.table("fact_order"), again.withColumn("ingested_at", F.current_timestamp()), ("order_id",), True, latest_by="placed_at"))
    assert not left_by(spark, lambda: storage.materialize(spark, raw.groupBy("order_id").count(), "counts"))
    assert spark.read.parquet(layout.table("fact_order")).count() == 1993


def test_the_session_keeps_its_own_setting(spark):
    was = spark.conf.get(_FILE_CLEANUP, None)
    for own in ("false", "true"):
        spark.conf.set(_FILE_CLEANUP, own)
        with released_shuffles(spark):
            assert spark.conf.get(_FILE_CLEANUP) == "true"
        assert spark.conf.get(_FILE_CLEANUP) == own
    spark.conf.set(_FILE_CLEANUP, was) if was is not None else spark.conf.unset(_FILE_CLEANUP)


def test_landed_text_is_compressed_and_reads_as_it_was(spark, tmp_root):
    layout = pipeline.Layout(f"{tmp_root}/raw", f"{tmp_root}/cur", f"{tmp_root}/wh")
    raw = raw_orders(spark)
    pipeline.land(spark, layout, {"order_events": raw})
    storage.write_landing(raw, f"{tmp_root}/plain")
    landed, plain = (storage.landed_files(spark, p) for p in (layout.raw("order_events"), f"{tmp_root}/plain"))
    weigh = [sum(f.size for f in files) for files in (landed, plain)]
    assert 3 * weigh[0] < weigh[1] == storage.text_bytes(plain)
    assert storage.text_bytes(landed) > weigh[1] / 2  # sizes the shuffles: near the text's size

    def rows(path, mark=None):
        got = storage.read_landing(spark, path, ORDER_EVENTS, True, mark).drop(LOAD_SEQ)
        return sorted(map(str, pipeline.cleanse.cast_columns(got, ORDER_EVENTS).collect()))

    assert rows(layout.raw("order_events")) == rows(f"{tmp_root}/plain") == sorted(map(str, raw.collect()))
    assert rows(layout.raw("order_events"), "2024-01-09") == rows(f"{tmp_root}/plain", "2024-01-09")
    assert storage.unknown_columns(spark, layout.raw("order_events"), ORDER_EVENTS) == []


def test_a_batch_without_beaten_rows_is_not_joined_with_the_quarantine(spark):
    shape = f"k string, at timestamp, {LOAD_SEQ} bigint"

    def frame(*rows, gone=None):
        df = spark.createDataFrame([(k, None, seq) for k, seq in rows], shape).withColumn("at", F.timestamp_seconds(F.lit(0)))
        return df if gone is None else df.withColumn(GONE, F.coalesce(F.col("k").isin(gone), F.lit(False)))

    def settle(batch, keep):
        got, left = ups.settle_quarantine(batch, frame(("a", 5), ("b", 5)), ("k",), "at", keep)
        return got, *[sorted(map(str, df.select("k", LOAD_SEQ).collect())) for df in (got, left)]

    kept = []

    def keep(met):
        kept.append(met)
        return spark.createDataFrame(met.collect(), met.schema)

    fresh = frame(("a", 6), ("c", 1), (None, 1), gone=["c"])
    for batch, joined in ((fresh, False), (frame(("a", 4), ("b", 7), ("c", 1), (None, 1), gone=["c"]), True)):
        plain, quick = settle(batch, None), settle(batch, keep)
        assert plain[1:] == quick[1:]
        assert ("LeftAnti" in quick[0]._jdf.queryExecution().optimizedPlan().toString()) == joined
    assert len(kept) == 2
    assert settle(fresh, keep)[2] == ["Row(k='b', load_seq=5)", "Row(k='c', load_seq=1)"]


def test_queries_leave_only_what_their_result_reads(spark, tmp_root):
    n, at = 400, F.timestamp_seconds(F.lit(790_000_000) + F.col("id") * 7200)
    orders = spark.range(n).select(F.col("id").alias("o_orderkey"), (F.col("id") % 31).alias("o_custkey"), F.lit("F").alias("o_orderstatus"),
                                   (F.col("id") * 1.5).alias("o_totalprice"), at.alias("o_orderdate"))
    lines = spark.range(2 * n).select((F.col("id") % n).alias("l_orderkey"), F.col("id").alias("l_partkey"), (F.col("id") % 13).alias("l_suppkey"),
                                      (F.col("id") % 3).cast("int").alias("l_linenumber"), F.lit("N").alias("l_returnflag"),
                                      F.lit("O").alias("l_linestatus"), at.alias("l_shipdate"))
    orders.write.parquet(f"{tmp_root}/orders.parquet")
    lines.write.parquet(f"{tmp_root}/lineitem.parquet")
    scratch = f"{checkpoint_dir(spark)}/fulfilq-tables".removeprefix("file:")

    def left_by_query(name):
        before = set(os.listdir(scratch)) if os.path.isdir(scratch) else set()
        rows = queries.QUERIES[name](spark, tmp_root).collect()
        new = [f"{scratch}/{d}" for d in set(os.listdir(scratch)) - before]
        return len(rows), sorted(os.path.basename(d).rsplit("-", 1)[0] + "/" + x for d in new for x in os.listdir(d)
                                 if x in ("raw", "curated") or "snapshot" in d)

    assert left_by_query("cleanse_counts") == (4, [])
    got = left_by_query("stored_upsert_shipments")
    assert got[0] > n and got[1] == []
