import datetime as dt

from pyspark.sql import functions as F

from fulfilq.operators import cleanse, upsert

D = dt.date


def _snaps(spark, rows):
    return spark.createDataFrame(rows, "warehouse_id string, snapshot_date date, utilization_pct double")


def _versions(df):
    return sorted((r.warehouse_id, r.effective_start_date, r.effective_end_date, r.is_current) for r in df.collect())


def test_scd2_one_two_and_gap(spark):
    df = _snaps(spark, [("A", D(2024, 1, 1), 50.0),
                        ("B", D(2024, 1, 1), 60.0), ("B", D(2024, 1, 2), 61.0), ("B", D(2024, 1, 5), 62.0)])
    assert _versions(cleanse.scd2_versions(df)) == [
        ("A", D(2024, 1, 1), None, True),
        ("B", D(2024, 1, 1), D(2024, 1, 2), False),
        ("B", D(2024, 1, 2), D(2024, 1, 5), False),
        ("B", D(2024, 1, 5), None, True),
    ]


def test_upsert_scd2_recloses_and_splits(spark):
    hist = cleanse.scd2_versions(_snaps(spark, [("A", D(2024, 1, 1), 50.0), ("A", D(2024, 1, 5), 55.0),
                                                ("B", D(2024, 1, 1), 70.0)]))
    batch = _snaps(spark, [("A", D(2024, 1, 3), 52.0), ("A", D(2024, 1, 7), 57.0)])  # late + new snapshot
    got = upsert.upsert_scd2(hist, batch)
    assert _versions(got) == [
        ("A", D(2024, 1, 1), D(2024, 1, 3), False),
        ("A", D(2024, 1, 3), D(2024, 1, 5), False),
        ("A", D(2024, 1, 5), D(2024, 1, 7), False),
        ("A", D(2024, 1, 7), None, True),
        ("B", D(2024, 1, 1), None, True),
    ]
    # exactly one current row per warehouse, intervals contiguous
    cur = got.groupBy("warehouse_id").agg(F.count_if("is_current").alias("c")).collect()
    assert all(r.c == 1 for r in cur)


def _facts(spark, rows):
    return spark.createDataFrame(rows, "order_id string, status string, event_date date")


def test_upsert_new_changed_unchanged_and_idempotent(spark):
    target = _facts(spark, [("o1", "PLACED", D(2024, 1, 1)), ("o2", "SHIPPED", D(2024, 1, 1)),
                            (None, "ORPHAN", D(2024, 1, 1))])
    batch = _facts(spark, [("o1", "DELIVERED", D(2024, 1, 2)), ("o3", "PLACED", D(2024, 1, 2))])
    once = upsert.upsert(target, batch, ["order_id"])
    rows = sorted(once.collect(), key=lambda r: (r.order_id or "", r.status))
    assert [(r.order_id, r.status) for r in rows] == [
        (None, "ORPHAN"), ("o1", "DELIVERED"), ("o2", "SHIPPED"), ("o3", "PLACED")]
    twice = upsert.upsert(once, batch, ["order_id"])
    assert sorted(map(tuple, twice.collect()), key=str) == sorted(map(tuple, once.collect()), key=str)


def test_touched_partitions_include_moved_keys(spark):
    target = _facts(spark, [("o1", "PLACED", D(2024, 1, 1)), ("o2", "SHIPPED", D(2024, 1, 3))])
    batch = _facts(spark, [("o1", "DELIVERED", D(2024, 1, 2))])  # o1 moves from Jan 1 to Jan 2
    got = sorted(r[0] for r in upsert.touched_values(target, batch, ["order_id"], "event_date").collect())
    assert got == [D(2024, 1, 1), D(2024, 1, 2)]


def test_scd2_invariants_on_fixture(spark):
    from fulfilq.plans.star import fixture_curated

    hist = fixture_curated(spark, "/root/testdata/sf0.001")["warehouse_capacity"]
    by_wh = {}
    for r in hist.select("warehouse_id", "effective_start_date", "effective_end_date", "is_current").collect():
        by_wh.setdefault(r.warehouse_id, []).append(r)
    assert len(by_wh) == 6
    for rows in by_wh.values():
        rows.sort(key=lambda r: r.effective_start_date)
        assert [r.is_current for r in rows].count(True) == 1 and rows[-1].is_current
        for a, b in zip(rows, rows[1:]):
            assert a.effective_end_date == b.effective_start_date   # half-open, contiguous
