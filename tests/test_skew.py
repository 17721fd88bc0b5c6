"""Hot keys: a third of all rows on one key must not change results, and the plans must pre-reduce them."""

from pyspark.sql import functions as F

from fulfilq.operators import cleanse, marts, upsert


def _plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_key_dedup_is_reduced_before_the_shuffle(spark):
    n = 30_000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("k"), F.col("id").cast("string")))
        .alias("k"),
        F.timestamp_seconds(F.col("id")).alias("ts"),
        F.col("id").alias("v"),
    )
    out = cleanse.dedup_latest(df, ["k"], "ts")
    rows = out.where(F.col("k") == "HOT").collect()
    assert len(rows) == 1 and rows[0].v == n - 3           # the latest of the hot key's copies
    assert out.count() == 1 + n - n // 3
    plan = _plan(out)
    # the partial limit runs map-side, below the exchange; the final one above it
    assert "row_number(), 1, Partial" in plan and "row_number(), 1, Final" in plan
    lines = plan.splitlines()
    partial = next(i for i, ln in enumerate(lines) if "1, Partial" in ln)
    exchange = next(i for i, ln in enumerate(lines) if "Exchange hashpartitioning" in ln)
    assert partial > exchange  # printed deeper = executed before the shuffle


def test_null_keys_bypass_the_upsert_join(spark):
    target = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, F.lit(None).cast("string")).otherwise(F.col("id").cast("string")).alias("k"),
        F.col("id").alias("v"))
    batch = spark.createDataFrame([("1", -1), ("2", -2), (None, -3)], "k string, v long")
    got = upsert.upsert(target, batch, ["k"])
    assert got.count() == 9000 + 1                          # 2 replaced, the NULL-key batch row is added
    assert got.where(F.col("k").isNull()).count() == 3000 + 1
    assert {r.v for r in got.where(F.col("k").isin("1", "2")).collect()} == {-1, -2}


def test_hot_warehouse_mart_matches_plain_sums(spark):
    # two thirds of all orders on one warehouse: partial aggregation, same totals
    from decimal import Decimal
    rows = [(f"o{i}", "W_HOT" if i % 3 else f"W{i % 7}", "DELIVERED", "Morning", 1, Decimal("1.00"), True, False,
             Decimal("2.00"), __import__("datetime").date(2024, 1, 1 + i % 5)) for i in range(3000)]
    schema = ("order_id string, warehouse_id string, order_status string, shift string, units_ordered int, "
              "order_value_usd decimal(10,2), prime_member boolean, sla_breach boolean, "
              "processing_hours decimal(8,2), event_date date")
    fo = spark.createDataFrame(rows, schema)
    m6 = marts.executive_summary(fo).first()
    m2 = marts.shift_performance(fo).agg(F.sum("orders_processed").alias("n")).first()
    assert m6.total_orders == 3000 and m2.n == 3000 and m6.total_revenue_usd == 3000.0
    assert "HashAggregate" in _plan(marts.shift_performance(fo))


def test_orphans_of_a_hot_id_stay_where_they_are(spark, monkeypatch):
    from fulfilq.operators import quality

    monkeypatch.setattr(quality, "HEAVY_IDS", 20)
    n = 60_000
    i = F.col("id")
    # a third of all rows on an id without an order, another third on one with an order, nulls and 1,000 light ids
    key = (F.when(i % 3 == 0, "HOT").when(i % 3 == 1, "SOLD").when(i % 300 == 2, F.lit(None))
           .otherwise(F.concat(F.lit("k"), F.pmod(i, F.lit(1000)).cast("string"))))
    rows = spark.range(0, n, 1, 8).select(key.alias("order_id"), i.alias("v"))
    orders = spark.range(0, 1000, 2).select(F.concat(F.lit("k"), i.cast("string")).alias("order_id"), F.lit("SHIPPED").alias("order_status"))
    orders = orders.unionByName(spark.createDataFrame([("SOLD", "SHIPPED"), ("HOT", "PLACED")], orders.schema))
    got = quality.orphan_shipments(rows, orders)
    sold = {r.order_id for r in orders.where("order_status = 'SHIPPED'").collect()}
    assert sorted(r.v for r in got.collect()) == [r.v for r in rows.orderBy("v").collect() if r.order_id not in sold]
    hot = got.where("order_id = 'HOT'").groupBy(F.spark_partition_id()).count().collect()
    sizes = sorted(r["count"] for r in hot)
    assert len(sizes) == 8 and sizes[-1] <= 2 * sizes[4]
    plan = _plan(got)
    assert "TakeOrderedAndProject" in plan  # the bound of what is broadcast


def test_orphan_listing_without_rows(spark):
    from fulfilq.operators import quality

    none = spark.createDataFrame([], "order_id string, v long")
    orders = spark.createDataFrame([("a", "SHIPPED")], "order_id string, order_status string")
    assert quality.orphan_shipments(none, orders).count() == 0
    some = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "order_id string, v long")
    assert sorted(r.v for r in quality.orphan_shipments(some, orders.limit(0)).collect()) == [1, 2, 3]
    assert sorted(r.v for r in quality.orphan_shipments(some, orders).collect()) == [2, 3]
