"""Stored upserts, landing headers and stream cuts keep every row (literal frames)."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from fulfilq.operators import dims
from fulfilq.plans import pipeline
from fulfilq.operators import upsert as ups
from fulfilq.schemas import LOAD_SEQ, ORDER_EVENTS, RETURNS_DEFECTS, SHIPMENT_TRACKING, WAREHOUSE_CAPACITY
from fulfilq.sources import storage
from fulfilq.streaming.ingest import start_ingest

DAY = [None] + [dt.date(2024, 1, d) for d in range(1, 32)]


def order(order_id, day, hour=10, status="DELIVERED"):
    """One raw order event; ``day`` 0: no event date."""
    placed = dt.datetime(2024, 1, day or 1, hour)
    return (order_id, "FC_00", "Books", status, placed, placed, placed, "Morning", 1, 5.0, True, False, 2.0, DAY[day])


def orders(spark, *rows):
    return spark.createDataFrame(list(rows), ORDER_EVENTS)


def shipment(shipment_id, day):
    t = dt.datetime(2024, 1, day, 9)
    return (shipment_id, "A", "FC_00", "UPS", "1Z", t, t, t, "DELIVERED", False, DAY[day])


def batch(spark, *rows):
    return dims.to_table(pipeline.cleanse.cleanse_orders(orders(spark, *rows)), "fact_order")


def stored(spark, path, *cols):
    return sorted(tuple(str(x) for x in r) for r in spark.read.parquet(path).select("order_id", *cols).collect())


def put(spark, path, *rows, **kw):
    return pipeline.upsert_table(spark, path, batch(spark, *rows), ("order_id",), True, latest_by="placed_at", **kw)


@pytest.fixture()
def layout(tmp_root):
    return pipeline.Layout(f"{tmp_root}/raw", f"{tmp_root}/cur", f"{tmp_root}/wh")


def test_null_date_rows_survive_an_upsert(spark, tmp_root):
    path = f"{tmp_root}/t"
    put(spark, path, order("A", 0), order("B", 0), order("C", 3))
    put(spark, path, order("D", 0))
    assert [r[0] for r in stored(spark, path)] == ["A", "B", "C", "D"]
    put(spark, path, order("D", 2, hour=12))  # D gets its date: no copy stays behind
    assert stored(spark, path, "event_date") == [("A", "None"), ("B", "None"), ("C", "2024-01-03"), ("D", "2024-01-02")]
    put(spark, path, order("A", 4, hour=12), order("B", 4, hour=12))
    assert not os.path.exists(f"{path}/event_date={pipeline.NULL_FOLDER}")
    assert len(stored(spark, path)) == 4


def test_an_empty_first_batch_leaves_no_broken_table(spark, tmp_root):
    path = f"{tmp_root}/t"
    put(spark, path)
    put(spark, path, order("A", 1))
    assert [r[0] for r in stored(spark, path)] == ["A"]


def test_a_stale_record_does_not_win(spark, tmp_root):
    path = f"{tmp_root}/t"
    put(spark, path, order("A", 5, hour=10))
    put(spark, path, order("A", 5, hour=9, status="PLACED"))
    assert stored(spark, path, "order_status") == [("A", "DELIVERED")]
    put(spark, path, order("A", 6, hour=9, status="RETURNED"))  # newer, and on another day
    assert stored(spark, path, "order_status", "event_date") == [("A", "RETURNED", "2024-01-06")]
    assert not os.path.exists(f"{path}/event_date=2024-01-05")


def test_a_batch_with_duplicates_loads_each_key_once(spark, tmp_root):
    path = f"{tmp_root}/t"
    twice = batch(spark, order("A", 1)).unionByName(batch(spark, order("A", 5, status="RETURNED")))
    pipeline.upsert_table(spark, path, twice, ("order_id",), True, latest_by="placed_at")
    assert stored(spark, path, "order_status") == [("A", "RETURNED")]
    pipeline.upsert_table(spark, path, twice, ("order_id",), True, latest_by="placed_at")
    assert stored(spark, path, "order_status") == [("A", "RETURNED")]


def test_fixed_days_spare_the_key_scan(spark, tmp_root):
    path = f"{tmp_root}/t"
    put(spark, path, order("A", 1), order("B", 2))
    put(spark, path, order("A", 1, hour=11, status="RETURNED"), keys_may_move=False)
    assert stored(spark, path, "order_status") == [("A", "RETURNED"), ("B", "DELIVERED")]


def test_incremental_cleanse_and_load_keep_keys_unique_and_null_dates(spark, layout):
    raw = layout.raw("order_events")
    storage.write_landing(orders(spark, order("A", 1), order("B", 1), order("N", 0)), raw)
    pipeline.run_cleanse(spark, layout)
    more = layout.landing + "/more"
    storage.write_landing(orders(spark, order("A", 5, status="RETURNED")), more)
    os.rename(f"{more}/date=2024-01-05", f"{raw}/date=2024-01-05")
    pipeline.run_cleanse(spark, layout, "2024-01-05")
    assert stored(spark, layout.cur("order_events"), "order_status") == [("A", "RETURNED"), ("B", "DELIVERED"), ("N", "DELIVERED")]
    pipeline.run_load(spark, layout, "2024-01-01")
    assert [r[0] for r in stored(spark, layout.table("fact_order"))] == ["A", "B", "N"]


def test_a_failed_table_is_loaded_by_the_next_auto_run(spark, layout, monkeypatch):
    storage.write_landing(orders(spark, order("A", 2), order("B", 9)), layout.raw("order_events"))
    ships = spark.createDataFrame([shipment("S1", 2), shipment("S2", 9)], SHIPMENT_TRACKING)
    storage.write_landing(ships, layout.raw("shipment_tracking"))
    real = pipeline.upsert_table

    def failing(spark, path, *a, **kw):
        if path.endswith("fact_shipment"):
            raise RuntimeError("lost")
        return real(spark, path, *a, **kw)

    monkeypatch.setattr(pipeline, "upsert_table", failing)
    with pytest.raises(RuntimeError):
        pipeline.run(spark, layout, "auto")
    monkeypatch.setattr(pipeline, "upsert_table", real)
    marks = pipeline.audit.resolve_watermarks(spark, layout.audit, ["fact_order", "fact_shipment"])
    assert marks == {"fact_order": "2024-01-09", "fact_shipment": None}
    pipeline.run_cleanse(spark, layout, marks)
    pipeline.run_load(spark, layout, marks)
    got = spark.read.parquet(layout.table("fact_shipment")).select("shipment_id").collect()
    assert sorted(r[0] for r in got) == ["S1", "S2"]


def test_capacity_rows_with_null_keys_are_replaced_on_a_rerun(spark, tmp_root):
    rows = [(DAY[1], "FC_00", "n", "r", 1, 1, 1.0, 2, 3), (DAY[1], None, "n", "r", 1, 1, 1.0, 2, 3), (None, "FC_00", "n", "r", 1, 1, 1.0, 2, 3)]
    snaps = pipeline.cleanse.cleanse_warehouse_capacity(spark.createDataFrame(rows, WAREHOUSE_CAPACITY))
    for _ in range(3):
        pipeline.upsert_table(
            spark, f"{tmp_root}/w", dims.to_table(snaps, "dim_warehouse"), ("warehouse_id", "effective_start_date"), False, scd2=True
        )
        assert spark.read.parquet(f"{tmp_root}/w").count() == 3


def csv_file(path, names, *rows):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write("\n".join([",".join(names), *(",".join(str(r.get(n, "")) for n in names) for r in rows)]) + "\n")


def test_files_with_unlike_headers_are_united_by_name(spark, layout):
    raw, names = layout.raw("order_events"), ORDER_EVENTS.names
    storage.write_landing(orders(spark, order("A", 1)), raw)
    row = {"order_id": "B", "warehouse_id": "W", "order_status": "SHIPPED", "placed_at": "2024-01-02T08:00:00", "event_date": "2024-01-02", "gate": "7"}
    csv_file(f"{raw}/date=2024-01-02/swapped.csv", [names[3], "gate", names[0], *names[1:3], *names[4:]], row)  # swapped, one more
    csv_file(f"{raw}/date=2024-01-03/short.csv", names[:5], {**row, "order_id": "C"})  # several missing
    csv_file(f"{raw}/date=2024-01-03/only-a-header.csv", names)
    open(f"{raw}/date=2024-01-03/empty.csv", "w").close()
    got = {r["order_id"]: r for r in storage.read_landing(spark, raw, ORDER_EVENTS).collect()}
    assert sorted(got) == ["A", "B", "C"] and got["B"]["warehouse_id"] == "W" and got["B"]["order_status"] == "SHIPPED"
    assert got["C"]["placed_at"] == "2024-01-02T08:00:00" and got["C"]["event_date"] is None
    late = storage.read_landing(spark, raw, ORDER_EVENTS, True, "2024-01-02").collect()
    assert sorted(r["order_id"] for r in late) == ["B", "C"]
    report = pipeline.run_cleanse(spark, layout)["order_events"]
    assert report["unknown_columns"] == ["gate"] and report["rows"] == 3
    start_ingest(spark, layout, "order_events", layout.landing + "/ckpt").awaitTermination()
    assert stored(spark, layout.table("fact_order"), "warehouse_id", "event_date") == [
        ("A", "FC_00", "2024-01-01"), ("B", "W", "2024-01-02"), ("C", "W", "None")]


def test_the_stream_does_not_depend_on_where_it_is_cut(spark, tmp_root):
    tables = []
    for max_files in (1, 1000):
        layout = pipeline.Layout(f"{tmp_root}/raw", f"{tmp_root}/cur", f"{tmp_root}/wh{max_files}")
        if max_files == 1:
            for i, r in enumerate([order("A", 1, 10), order("A", 1, 9, "PLACED"), order("B", 0), order("A", 2, 8, "RETURNED"), order("B", 3),
                                   order("C", 4, 8, "SHIPPED"), order("C", 4, 8, "DELIVERED"), order("C", 4, 8, "RETURNED"), order("C", 4, 8, "PLACED")]):
                one = f"{tmp_root}/one{i}"
                storage.write_landing(orders(spark, r).coalesce(1), one, partitioned=False)
                os.makedirs(f"{layout.raw('order_events')}/date={r[-1] or 'unknown'}", exist_ok=True)
                part = next(f for f in os.listdir(one) if f.endswith(".csv"))
                os.rename(f"{one}/{part}", f"{layout.raw('order_events')}/date={r[-1] or 'unknown'}/{i}.csv")
                os.utime(f"{layout.raw('order_events')}/date={r[-1] or 'unknown'}/{i}.csv", (1_700_000_000 + i,) * 2)
        start_ingest(spark, layout, "order_events", f"{tmp_root}/ckpt{max_files}", max_files=max_files).awaitTermination()
        tables.append(stored(spark, layout.table("fact_order"), "order_status", "event_date"))
    assert tables[0] == tables[1] == [("A", "RETURNED", "2024-01-02"), ("B", "DELIVERED", "2024-01-03"), ("C", "PLACED", "2024-01-04")]


def test_swap_leaves_the_old_copy_when_the_new_is_missing(spark, tmp_root):
    spark.range(3).write.parquet(f"{tmp_root}/t")
    with pytest.raises(OSError):
        storage.swap_in(spark, f"{tmp_root}/nothing", f"{tmp_root}/t")
    assert spark.read.parquet(f"{tmp_root}/t").count() == 3


def test_a_cluster_without_a_shared_folder_is_refused():
    from fulfilq import session

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "yarn"

        def getConf(self):
            return Conf()

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(Session())


def test_seed_dimensions_are_stored_and_upserted_by_name(spark, layout):
    pipeline.load_seeds(spark, layout)
    new = spark.createDataFrame([("DroneExpress", "Regional"), ("UPS", "International")], "carrier_name string, carrier_type string")
    new = new.select(F.xxhash64("carrier_name").alias("carrier_sk"), "*")
    pipeline.upsert_dimension(spark, layout, "dim_carrier", new)
    pipeline.load_seeds(spark, layout)  # a later run keeps what was added and changed
    got = {r["carrier_name"]: r["carrier_type"] for r in pipeline.load_star(spark, layout)["dim_carrier"].collect()}
    assert got["DroneExpress"] == "Regional" and got["UPS"] == "International" and len(got) == 6
    assert pipeline.load_star(spark, layout)["dim_date"].count() == 1461


def test_smoke_reads_the_curated_files(spark, layout):
    storage.write_landing(orders(spark, order("A", 1), order("B", 2)), layout.raw("order_events"))
    got = pipeline.run_cleanse(spark, layout)["order_events"]
    assert got["nulls"]["order_id"] == 0 and got["raw_rows"] == 2
    assert all(r.passed for r in pipeline.smoke(spark, layout).collect())


# ---------------------------------------------------------------------------
# The later arrival wins a tie
# ---------------------------------------------------------------------------
def test_an_update_at_the_same_time_is_taken(spark, tmp_root):
    path = f"{tmp_root}/t"
    put(spark, path, order("A", 1, status="PLACED"), order("B", 1, status="ZZ"))
    for status in ("DELIVERED", "PLACED", "SHIPPED"):  # later and earlier in the alphabet
        put(spark, path, order("A", 1, status=status))
        assert stored(spark, path, "order_status") == [("A", status), ("B", "ZZ")]


def test_the_order_of_arrival_decides_not_the_order_of_batches(spark):
    def frame(*rows):
        return spark.createDataFrame(list(rows), f"k string, at timestamp, v int, {LOAD_SEQ} bigint")

    t = dt.datetime(2024, 1, 1)
    batches = [frame(("a", t, 1, 10)), frame(("a", t, 2, 30)), frame(("a", t, 3, 20)), frame(("a", None, 4, 40))]
    for order_ in ((0, 1, 2, 3), (3, 1, 2, 0)):
        table = batches[order_[0]]
        for i in order_[1:]:
            merged = ups.upsert(table, batches[i], ["k"], "at")
            table = spark.createDataFrame(merged.collect(), merged.schema)
        assert [r["v"] for r in table.collect()] == [2]


def land(layout, dataset, name, names, *rows, at):
    path = f"{layout.raw(dataset)}/{name}"
    csv_file(path, names, *rows)
    os.utime(path, (at, at))


def test_land_load_land_load(spark, layout):
    names = ORDER_EVENTS.names
    row = {"order_id": "A", "order_status": "PLACED", "placed_at": "2024-01-02T08:00:00", "event_date": "2024-01-02", "order_value_usd": "20.0"}
    b = {**row, "order_id": "B"}
    for i, (status, value) in enumerate((("PLACED", "20.0"), ("DELIVERED", "15.0"), ("CANCELLED", "25.0"))):
        land(layout, "order_events", f"date=2024-01-02/{i}.csv", names, {**row, "order_status": status, "order_value_usd": value}, b, at=1_700_000_000 + i)
        for mark in (None, "2024-01-02"):  # the full run and the increment
            pipeline.run_cleanse(spark, layout, mark)
            pipeline.run_load(spark, layout, mark)
            for path in (layout.cur("order_events"), layout.table("fact_order")):
                assert stored(spark, path, "order_status", "order_value_usd")[0][1:] in ((status, value), (status, value + "0"))


# ---------------------------------------------------------------------------
# Days are replaced all or nothing
# ---------------------------------------------------------------------------
def test_a_crash_at_any_step_loses_no_row(spark, tmp_root, monkeypatch):
    real = {n: getattr(storage, n) for n in ("_move", "_write_text", "remove")}

    def frame(*rows):
        return spark.createDataFrame([(k, DAY[d]) for k, d in rows], "order_id string, event_date date").coalesce(1)

    old, new = frame(("A", 1), ("B", 2), ("C", 3), ("N", 0)), frame(("A", 4), ("B2", 2), ("N2", 0))  # day 1 empties
    days = [DAY[d] for d in (0, 1, 2, 4)]
    before = [("A", "2024-01-01"), ("B", "2024-01-02"), ("C", "2024-01-03"), ("N", "None")]
    after = [("A", "2024-01-04"), ("B2", "2024-01-02"), ("C", "2024-01-03"), ("N2", "None")]
    outcomes, done, at = set(), False, 0
    while not done:
        at, path, steps = at + 1, f"{tmp_root}/t{at}", []
        storage.replace_days(spark, old, path, ["order_id"])

        def failing(name, at=at, steps=steps):
            def step(*a):
                steps.append(name)
                if len(steps) == at:
                    raise RuntimeError("lost")
                return real[name](*a)
            return step

        for n in real:
            monkeypatch.setattr(storage, n, failing(n))
        try:
            storage.replace_days(spark, new, path, ["order_id"], days)
            done = True
        except RuntimeError:
            pass
        for n, f in real.items():
            monkeypatch.setattr(storage, n, f)
        storage.recover(spark, path)
        got = stored(spark, path, "event_date")
        assert got in (before, after), steps
        assert not os.path.exists(path + ".swap-journal")
        outcomes.add((len(steps) > 1, got == after))
    # only a crash before the journal is there leaves the old days
    assert at > 9 and outcomes == {(False, False), (True, True)}


def test_rows_of_other_days_are_not_replaced_by_mistake(spark, tmp_root):
    path = f"{tmp_root}/t"
    put(spark, path, order("A", 1))
    with pytest.raises(ValueError, match="not to be replaced"):
        storage.replace_days(spark, batch(spark, order("B", 1)), path, ["order_id"], [DAY[2]])
    assert [r[0] for r in stored(spark, path)] == ["A"]


def test_a_full_run_drops_days_without_rows(spark, layout):
    raw = layout.raw("order_events")
    csv_names = ORDER_EVENTS.names
    a = {"order_id": "A", "order_status": "PLACED", "placed_at": "2024-01-01T08:00:00", "event_date": "2024-01-01"}
    land(layout, "order_events", "date=2024-01-01/0.csv", csv_names, a, at=1_700_000_000)
    land(layout, "order_events", "date=2024-01-02/0.csv", csv_names, {**a, "order_id": "B", "event_date": "2024-01-02"}, at=1_700_000_000)
    pipeline.run_cleanse(spark, layout)
    land(layout, "order_events", "date=2024-01-05/0.csv", csv_names, {**a, "placed_at": "2024-01-05T08:00:00", "event_date": "2024-01-05"}, at=1_700_000_001)
    assert os.path.isdir(raw) and pipeline.run_cleanse(spark, layout)["order_events"]["rows"] == 2
    assert stored(spark, layout.cur("order_events"), "event_date") == [("A", "2024-01-05"), ("B", "2024-01-02")]


# ---------------------------------------------------------------------------
# Flat landings only when changed
# ---------------------------------------------------------------------------
def test_an_unchanged_returns_file_is_skipped_and_a_changed_one_touches_its_days(spark, layout):
    names = RETURNS_DEFECTS.names
    rows = [{"record_id": f"R{i}", "order_id": f"O{i}", "report_type": "RETURN", "reported_at": f"2024-01-0{i}T08:00:00",
             "refund_issued": "True", "event_date": f"2024-01-0{i}"} for i in (1, 2, 3)]
    land(layout, "returns_defects", "r.csv", names, *rows, at=1_700_000_000)
    assert pipeline.run_cleanse(spark, layout)["returns_defects"]["rows"] == 3
    assert pipeline.run_load(spark, layout)["fact_returns_defects"] == 3
    assert pipeline.run_cleanse(spark, layout)["returns_defects"] is None
    assert pipeline.run_load(spark, layout)["fact_returns_defects"] is None
    table = layout.table("fact_returns_defects")
    files = {d: sorted(os.listdir(f"{table}/{d}")) for d in os.listdir(table) if d.startswith("event")}
    rows[1]["refund_issued"] = "False"  # withdrawn: same time, smaller value
    land(layout, "returns_defects", "r.csv", names, *rows, at=1_700_000_001)
    assert pipeline.run_cleanse(spark, layout)["returns_defects"]["rows"] == 3
    assert pipeline.run_load(spark, layout)["fact_returns_defects"] == 1
    now = {d: sorted(os.listdir(f"{table}/{d}")) for d in os.listdir(table) if d.startswith("event")}
    assert {d for d in now if now[d] != files[d]} == {"event_date=2024-01-02"}
    got = {r["record_id"]: r["refund_issued"] for r in spark.read.parquet(table).collect()}
    assert got == {"R1": True, "R2": False, "R3": True}


# ---------------------------------------------------------------------------
# A shipment whose newest record is incomplete
# ---------------------------------------------------------------------------
def test_increments_and_stream_end_in_the_table_of_the_full_batch(spark, tmp_root):
    names = SHIPMENT_TRACKING.names

    def ship(sid, day, hour, order_id="O", status="SHIPPED"):
        at = f"2024-01-0{day}T{hour:02}:00:00"
        return {"shipment_id": sid, "order_id": order_id, "shipped_at": at, "delivery_status": status, "event_date": f"2024-01-0{day}"}

    # K: complete, then incomplete and newer, then a late complete one of before; L comes back; M is incomplete first
    days = [[ship("K", 1, 8), ship("L", 1, 8), ship("M", 1, 9, "")],
            [ship("K", 2, 8, ""), ship("L", 2, 8, ""), ship("N", 2, 8)],
            [ship("K", 3, 1) | {"shipped_at": "2024-01-01T20:00:00"}, ship("L", 3, 8, status="DELIVERED"), ship("M", 3, 1) | {"shipped_at": "2024-01-01T07:00:00"}],
            [ship("N", 4, 8, "") | {"shipped_at": "2024-01-02T08:00:00"}]]  # a tie: the later arrival is incomplete
    tables = {}
    for kind in ("full", "increments", "stream1", "stream1000"):
        layout = pipeline.Layout(f"{tmp_root}/{kind}/raw", f"{tmp_root}/{kind}/cur", f"{tmp_root}/{kind}/wh")
        for d, rows in enumerate(days, 1):
            land(layout, "shipment_tracking", f"date=2024-01-0{d}/x.csv", names, *rows, at=1_700_000_000 + d)
            if kind == "increments":
                pipeline.run_cleanse(spark, layout, f"2024-01-0{d}")
                pipeline.run_load(spark, layout, f"2024-01-0{d}")
        if kind == "full":
            pipeline.run_cleanse(spark, layout)
            pipeline.run_load(spark, layout)
        elif kind != "increments":
            start_ingest(spark, layout, "shipment_tracking", f"{tmp_root}/{kind}/ckpt", max_files=int(kind[6:])).awaitTermination()
        table = spark.read.parquet(layout.table("fact_shipment")).drop("ingested_at", LOAD_SEQ)
        tables[kind] = sorted(str(r) for r in table.select(sorted(table.columns)).collect())
        ids = sorted(r["shipment_id"] for r in table.collect())
        assert ids == ["L"], (kind, ids)
    assert len({str(t) for t in tables.values()}) == 1


def test_a_load_reads_the_curated_files_and_looks_up_their_keys_once(spark, layout, monkeypatch):
    storage.write_landing(orders(spark, order("A", 1), order("B", 2), order("N", 0)), layout.raw("order_events"))
    pipeline.run_cleanse(spark, layout)
    assert pipeline.run_load(spark, layout)["fact_order"] == 3
    staged, asked = [], []
    copy, ask = storage.materialize, pipeline.key_sketch.days_that_may_hold
    monkeypatch.setattr(storage, "materialize", lambda s, df, name, *a, **k: staged.append(name) or copy(s, df, name, *a, **k))
    monkeypatch.setattr(pipeline.key_sketch, "days_that_may_hold", lambda *a, **k: asked.append(a[1]) or ask(*a, **k))
    assert pipeline.run_load(spark, layout)["fact_order"] == 3
    assert staged == ["hits"] and asked == [layout.table("fact_order")]
    assert [r[0] for r in stored(spark, layout.table("fact_order"))] == ["A", "B", "N"]


def test_both_batches_come_from_one_copy_of_the_facts(spark, monkeypatch):
    from fulfilq.plans import queries

    staged, copy = [], storage.materialize
    monkeypatch.setattr(storage, "materialize", lambda s, df, name, *a, **k: staged.append(name) or copy(s, df, name, *a, **k))
    facts = batch(spark, order("A", 3), order("B", 20))
    never = F.lit(False)
    roles = dict.fromkeys(("undated", "moved", "stale", "twice", "tie"), never)
    left = queries._stored_upsert(spark, "orders", facts, ["order_id"], "placed_at", roles, {})
    assert staged[0] == "snapshot" and sorted(r.order_id for r in left.collect()) == ["A", "B"]
