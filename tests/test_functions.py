import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from fulfilq.functions import (
    avg_positive_round2,
    avg_round2,
    date_key,
    delay_hours,
    pct,
    shift_of_hour,
    sla_breach,
    speed_tier,
)


def test_pct_rounds_half_up_and_guards_zero(spark):
    df = spark.createDataFrame([(1, 8), (1, 800), (0, 0), (2, 3), (None, 5)], "n long, d long")
    got = [r[0] for r in df.select(pct(F.col("n"), F.col("d"))).collect()]
    assert got == [12.5, 0.13, None, 66.67, None]


def test_avg_round2_is_exact_on_ties(spark):
    # 1.005 as a double is 1.00499..., an exact decimal average must still round up.
    df = spark.createDataFrame([(Decimal("1.00"),), (Decimal("1.01"),)], "x decimal(8,2)")
    assert df.agg(avg_round2("x")).first()[0] == 1.01
    neg = spark.createDataFrame([(Decimal("-1.00"),), (Decimal("-1.01"),)], "x decimal(8,2)")
    assert neg.agg(avg_round2("x")).first()[0] == -1.01


def test_avg_positive_excludes_sentinels(spark):
    df = spark.createDataFrame([(Decimal("-1.00"),), (Decimal("0.00"),), (Decimal("3.00"),), (None,)], "x decimal(8,2)")
    assert df.agg(avg_positive_round2("x")).first()[0] == 3.0
    empty = spark.createDataFrame([], "x decimal(8,2)")
    assert empty.agg(avg_positive_round2("x")).first()[0] is None


def test_speed_tier_boundaries(spark):
    df = spark.createDataFrame([(12.0,), (12.01,), (24.0,), (24.01,), (-1.0,), (None,)], "h double")
    got = [r[0] for r in df.select(speed_tier("h")).collect()]
    assert got == ["Fast", "Standard", "Standard", "Slow", "Fast", "Unknown"]


def test_shift_of_hour(spark):
    rows = [(dt.datetime(2024, 1, 1, h, 30),) for h in (0, 5, 6, 13, 14, 21, 22, 23)]
    df = spark.createDataFrame(rows, "ts timestamp")
    got = [r[0] for r in df.select(shift_of_hour("ts")).collect()]
    assert got == ["Night", "Night", "Morning", "Morning", "Afternoon", "Afternoon", "Night", "Night"]


def test_delay_hours(spark):
    base = dt.datetime(2024, 1, 1, 12, 0)
    rows = [
        (base, base - dt.timedelta(hours=2)),               # early -> negative
        (base, base + dt.timedelta(minutes=30, seconds=18)),  # late 0.505 h -> 0.51 (half up)
        (base, None),                                      # undelivered
        (None, base),                                      # no estimate
    ]
    df = spark.createDataFrame(rows, "est timestamp, act timestamp")
    got = [r[0] for r in df.select(delay_hours("act", "est")).collect()]
    assert got == [-2.0, 0.51, None, None]


def test_sla_breach_rule(spark):
    p = dt.datetime(2024, 1, 1, 0, 0)
    rows = [(p, None, 24), (p, p + dt.timedelta(hours=24), 24), (p, p + dt.timedelta(hours=24, seconds=1), 24)]
    df = spark.createDataFrame(rows, "placed timestamp, shipped timestamp, sla int")
    got = [r[0] for r in df.select(sla_breach("placed", "shipped", "sla")).collect()]
    assert got == [True, False, True]


def test_date_key(spark):
    df = spark.createDataFrame([(dt.date(2027, 12, 31),)], "d date")
    assert df.select(date_key("d")).first()[0] == 20271231
