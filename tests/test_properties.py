"""Property tests: exact half-up ratios against Python fractions."""

from decimal import ROUND_HALF_UP, Decimal
from fractions import Fraction

from hypothesis import given, settings
from hypothesis import strategies as st

from clicklens.functions.columns import half_up_ratio


def _expected(x: int, n: int):
    if n == 0:
        return None
    exact = Fraction(x, n) * 100
    floor = exact.numerator // exact.denominator
    rounded = floor + (1 if exact - floor >= Fraction(1, 2) else 0)
    return rounded / 100


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 10**6), st.integers(0, 10**6)), min_size=50, max_size=200))
def test_half_up_ratio_matches_fraction(spark, pairs):
    pairs = [(min(x, n), n) for x, n in pairs] + [(1, 8), (3, 8), (1, 200), (0, 0)]
    df = spark.createDataFrame(pairs, "x long, n long")
    got = [r.r for r in df.select(half_up_ratio("x", "n").alias("r")).collect()]
    assert got == [_expected(x, n) for x, n in pairs]


def test_half_up_ratio_ties_round_up(spark):
    # exact ties k/200 with k odd: always up (binary rounding would not be)
    pairs = [(k, 200) for k in range(1, 200, 2)]
    df = spark.createDataFrame(pairs, "x long, n long")
    got = [r.r for r in df.select(half_up_ratio("x", "n").alias("r")).collect()]
    want = [float((Decimal(k) / Decimal(200)).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)) for k, _ in pairs]
    assert got == want
