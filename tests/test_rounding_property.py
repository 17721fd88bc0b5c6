"""Property: rates and averages equal exact half-up decimal arithmetic (no double drift)."""

from decimal import ROUND_HALF_UP, Decimal
from fractions import Fraction

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fulfilq.functions import avg_round2, pct


def _half_up(q: Fraction, digits: int = 2) -> float:
    d = Decimal(q.numerator) / Decimal(q.denominator)
    return float(d.quantize(Decimal(1).scaleb(-digits), rounding=ROUND_HALF_UP))


cents = st.integers(min_value=-99_999_99, max_value=99_999_99)


@settings(max_examples=25, deadline=None)
@given(st.lists(cents, min_size=1, max_size=40))
def test_avg_round2_exact(spark, values):
    df = spark.createDataFrame([(Decimal(v).scaleb(-2),) for v in values], "x decimal(10,2)")
    got = df.agg(avg_round2("x")).first()[0]
    exact = Fraction(sum(values), 100 * len(values))
    q = Decimal(exact.numerator) / Decimal(exact.denominator)
    want = float(q.quantize(Decimal("0.01"), rounding=ROUND_HALF_UP))
    assert got == want


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 10**6), st.integers(1, 10**6)), min_size=1, max_size=20))
def test_pct_exact(spark, pairs):
    pairs = [(min(n, d), d) for n, d in pairs]
    df = spark.createDataFrame(pairs, "n long, d long")
    got = [r[0] for r in df.select(pct(F.col("n"), F.col("d"))).collect()]
    assert got == [_half_up(Fraction(100 * n, d)) for n, d in pairs]
