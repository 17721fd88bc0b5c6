"""Key sketches name the days of a key; colliding surrogate keys fail a load (literal frames)."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from fulfilq.plans import pipeline
from fulfilq.sources import key_sketch, storage

KEYS = ["order_id"]


def rows(spark, n, start=0, days=10, shift=0):
    return spark.range(start, start + n).select(
        F.concat(F.lit("o"), F.col("id").cast("string")).alias("order_id"),
        F.timestamp_seconds(F.col("id") + F.lit(shift)).alias("placed_at"),
        F.col("id").alias("v"),
        F.date_add(F.lit("2024-01-01").cast("date"), F.pmod(F.col("id") + shift, F.lit(days)).cast("int")).alias("event_date"),
    )


def put(spark, path, df, **kw):
    return pipeline.upsert_table(spark, path, df, KEYS, True, latest_by="placed_at", unique=True, **kw)


def content(spark, path):
    return sorted(tuple(r) for r in spark.read.parquet(path).select("order_id", "v", "event_date").collect())


def may_hold(spark, path, *ids):
    return key_sketch.days_that_may_hold(spark, path, spark.createDataFrame([(i,) for i in ids], "order_id string"), KEYS)


def test_no_stored_key_is_missed_and_few_days_are_named_for_nothing(spark, tmp_root):
    path = f"{tmp_root}/t"
    put(spark, path, rows(spark, 40_000))  # 4,000 keys a day: four blocks
    assert os.path.isdir(f"{path}/_keys") and spark.read.parquet(path).count() == 40_000
    for i in (0, 7, 19_999, 39_995):
        assert f"2024-01-{i % 10 + 1:02d}" in may_hold(spark, path, f"o{i}")
    # every key of one day: that day, and hardly another
    day = spark.read.parquet(path).where("event_date = '2024-01-04'").select("order_id")
    assert "2024-01-04" in key_sketch.days_that_may_hold(spark, path, day, KEYS)
    assert may_hold(spark, path, *[f"new{i}" for i in range(2_000)]) == set()  # 20,000 looks, each wrong 1 in 200,000


def test_a_moved_key_leaves_no_copy_with_and_without_a_sketch(spark, tmp_root):
    a, b = f"{tmp_root}/a", f"{tmp_root}/b"
    first, moved = rows(spark, 3_000), rows(spark, 500, start=1_000, shift=3)
    for path in (a, b):
        put(spark, path, first)
    storage.remove(spark, f"{b}/_keys")  # an older table: every day is looked at
    assert may_hold(spark, b, "nobody") == {f"2024-01-{d:02d}" for d in range(1, 11)}
    for path in (a, b):
        put(spark, path, moved)
    want = {r[0]: tuple(r) for r in first.select("order_id", "v", "event_date").collect()}
    want |= {r[0]: tuple(r) for r in moved.select("order_id", "v", "event_date").collect()}
    assert content(spark, a) == content(spark, b) == sorted(want.values())


def test_only_named_days_are_read_and_rewritten(spark, tmp_root):
    path = f"{tmp_root}/t"
    put(spark, path, rows(spark, 2_000))
    before = key_sketch.fingerprints(spark, path)
    put(spark, path, rows(spark, 1, start=12, shift=4))  # o12 moves from day 3 to day 7
    after = key_sketch.fingerprints(spark, path)
    assert {d for d in before if before[d] != after[d]} == {"event_date=2024-01-03", "event_date=2024-01-07"}
    assert may_hold(spark, path, "o12") == {"2024-01-07"}


def test_days_rewritten_by_others_are_not_trusted(spark, tmp_root):
    path = f"{tmp_root}/t"
    put(spark, path, rows(spark, 100))
    storage.write_partitioned(rows(spark, 1, start=900_000), path, KEYS)  # lands on day 1, past the sketch
    assert may_hold(spark, path, "o900000") == {"2024-01-01"}
    put(spark, path, rows(spark, 1, start=900_000, shift=5))
    assert [r for r in content(spark, path) if r[0] == "o900000"] == [("o900000", 900_000, dt.date(2024, 1, 6))]


def test_null_dates_null_keys_and_emptied_days(spark, tmp_root):
    path = f"{tmp_root}/t"
    undated = rows(spark, 5).withColumn("event_date", F.lit(None).cast("date"))
    keyless = rows(spark, 3, start=50).withColumn("order_id", F.lit(None).cast("string"))
    put(spark, path, undated.unionByName(keyless).unionByName(rows(spark, 1, start=8)))
    assert storage.NULL_FOLDER in may_hold(spark, path, "o2")
    put(spark, path, rows(spark, 5, shift=1))  # all get a date: the NULL day and its sketch go
    put(spark, path, rows(spark, 1, start=8, shift=1))
    assert not os.path.exists(f"{path}/event_date={storage.NULL_FOLDER}")
    assert not os.path.exists(f"{path}/_keys/event_date={storage.NULL_FOLDER}")
    assert len(content_ids := [r.order_id for r in spark.read.parquet(path).collect()]) == 9 and content_ids.count(None) == 3
    assert key_sketch.days_that_may_hold(spark, path, rows(spark, 5).limit(0), KEYS) <= {"2024-01-01"} | {
        f.split("=")[1] for f in storage.files(spark, path)}


def test_days_without_sketches_after_a_load_with_keys_that_never_move(spark, tmp_root):
    path = f"{tmp_root}/t"
    put(spark, path, rows(spark, 100))
    put(spark, path, rows(spark, 1, start=11), keys_may_move=False)
    assert not os.path.exists(f"{path}/_keys/event_date=2024-01-02")
    assert may_hold(spark, path, "nobody") == {"2024-01-02"}


def weak(keys):
    return F.pmod(F.length(F.concat_ws("", *keys)), F.lit(3)).cast("bigint")


def test_colliding_surrogate_keys_fail_the_load(spark, tmp_root, monkeypatch):
    a = spark.createDataFrame([("A",), ("BB",)], "order_id string")
    key_sketch.check_collisions(None, a, KEYS, "t")
    key_sketch.check_collisions(a, a, KEYS, "t")  # the same key again is no collision
    monkeypatch.setattr(key_sketch, "key_hash", weak)
    key_sketch.check_collisions(None, a, KEYS, "t")
    with pytest.raises(key_sketch.KeyCollision, match="'A'"):
        key_sketch.check_collisions(a, spark.createDataFrame([("AAAA",), (None,)], "order_id string"), KEYS, "t")
    with pytest.raises(key_sketch.KeyCollision):
        key_sketch.check_collisions(None, a.union(spark.createDataFrame([("C",)], "order_id string")), KEYS, "t")


def test_a_collision_with_a_stored_key_of_another_day_is_found_through_the_sketches(spark, tmp_root, monkeypatch):
    monkeypatch.setattr(key_sketch, "key_hash", weak)
    path = f"{tmp_root}/fact"
    one = rows(spark, 1, start=1)
    put(spark, path, one.withColumn("order_id", F.lit("A")))
    clash = rows(spark, 1, start=5).withColumn("order_id", F.lit("DDDD"))
    with pytest.raises(key_sketch.KeyCollision, match="'DDDD'"):
        pipeline._check_surrogate_keys(spark, path, clash, KEYS, "fact", True)
    pipeline._check_surrogate_keys(spark, path, clash.withColumn("order_id", F.lit("EE")), KEYS, "fact", True)


def test_composite_keys(spark):
    rows_ = spark.createDataFrame([("w", dt.date(2024, 1, 1)), ("w", dt.date(2024, 1, 2)), ("w", None)], "warehouse_id string, d date")
    key_sketch.check_collisions(rows_, rows_, ["warehouse_id", "d"], "dim")


def test_a_block_is_filled_whole_however_its_keys_are_dealt_over_batches():
    import numpy as np
    import pyarrow as pa

    rng = np.random.default_rng(5)
    n = 5_000
    block = np.sort(rng.integers(0, 700, n))  # more blocks than are spread out at once, most of them over a batch's end
    first, step = rng.integers(0, key_sketch.BLOCK_BITS, (2, n))
    whole = pa.RecordBatch.from_arrays(
        [pa.array(block // 400, pa.int32()), pa.array(block, pa.int64()), pa.array(first, pa.int32()), pa.array(step, pa.int32())],
        ["place", "block", "first", "step"])
    want = {}
    for b, f, s in zip(block.tolist(), first.tolist(), step.tolist(), strict=True):
        words = want.setdefault((b // 400, b), [0] * (key_sketch.BLOCK_BITS // 64))
        for i in range(key_sketch.BITS):
            at = (f + i * s) % key_sketch.BLOCK_BITS
            words[at // 64] |= 1 << at % 64
    for size in (n, 7, 1_000):
        parts = [whole.slice(lo, size) for lo in range(0, n, size)]
        got = [r for out in key_sketch._fill_blocks(iter([whole.slice(0, 0), *parts])) for r in out.to_pylist()]
        assert len(got) == len(want)
        assert {(r["place"], r["block"]): [w % 2**64 for w in r["bits"]] for r in got} == want
    assert list(key_sketch._fill_blocks(iter([]))) == []


def test_a_sketch_shuffles_a_row_per_key_not_per_bit(spark, tmp_root, monkeypatch):
    frame = type(spark.range(0))
    plans, write = [], frame.write.fget

    def seen(df):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return write(df)

    rows(spark, 100).write.partitionBy("event_date").parquet(f"{tmp_root}/t")
    monkeypatch.setattr(frame, "write", property(seen))
    key_sketch.write(spark, f"{tmp_root}/t", KEYS)
    assert plans and not any("Generate" in p or "bit_or" in p for p in plans)


def test_only_hashes_that_come_twice_have_their_keys_compared(spark, monkeypatch):
    monkeypatch.setattr(key_sketch, "key_hash", weak)
    batch = spark.createDataFrame([("A",), ("A",), ("DDDD",), ("BB",), ("BB",), (None,)], "order_id string")
    found = key_sketch.collisions(None, batch, KEYS)
    assert [(*r.a, *r.b) for r in found.collect()] == [("A", "DDDD")]
    assert "LeftSemi" in found._jdf.queryExecution().optimizedPlan().toString()
