"""Sums of floating values in windows: exact at any magnitude, the same on the plain and the blocked path."""

import math
import random
from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from histwise.operators import skew
from histwise.operators import windows as W
from histwise.plans import evaluate as E


def logs(spark, values, users=2):
    rows = [(i, i % users, i // 2, v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "row_id long, user_id long, timestamp long, v double")


def exact(values, users, width):
    out = {}
    for i in range(len(values)):
        earlier = [values[j] for j in range(i % users, i, users)]
        frame = [v for v in (earlier if width is None else earlier[-width:]) if v is not None]
        out[i] = float(sum(map(Fraction, frame))) if frame else None
    return out


def spec():
    return W.Spec(("user_id",), slides={"s3": (F.col("v"), 3), "s50": (F.col("v"), 50)}, sums_before={"all": F.col("v")})


CASES = {
    "tiny": [1e-17, 2e-17, 3e-17, 1.5e-17] * 20,
    "tiny beside huge": [1e19, 1e-17, 1e-17, 1e-17, 1e-17, 1e-17, 1e-17, 5e-17, 1e-17, 2.5] * 8,
    "signs cancel": [1e16, 1.0, -1e16, 0.1, -0.3, 0.0] * 12,
    "weights": [999.0, 0.1, 1 / 3, None, 0.0, 2 / 7] * 12,
    "none": [None] * 12,
}


@pytest.mark.parametrize("case", CASES)
def test_sums_at_any_magnitude(spark, case):
    values = CASES[case]
    df = logs(spark, values)
    plain = {r["row_id"]: r for r in E.compute_windows(df, [spec()]).collect()}
    for name, width in (("s3", 3), ("s50", 50), ("all", None)):
        want = exact(values, 2, width)
        for i, w in want.items():
            got = plain[i][name]
            if w is None:
                assert got is None
            else:  # put together from a few exact sums, hence right but for the last bits of the largest of them
                sizes = [abs(v) for v in values[i % 2:i:2][-(width or len(values)):] if v is not None]
                assert math.isclose(got, w, rel_tol=1e-15, abs_tol=max(sizes) * 1e-31 if sizes else 0), (name, i, got, w)
    if case not in ("tiny beside huge", "weights"):
        return
    hot = skew.hot_keys(df.select("user_id"), ("user_id",), skew.SkewPolicy(max_rows_per_key=2, block_rows=5))
    assert hot is not None and hot.n_blocks > 1
    blocked = {r["row_id"]: r for r in E.compute_windows(df, [spec()], None, hot).collect()}
    assert {i: tuple(r) for i, r in blocked.items()} == {i: tuple(plain[i][c] for c in r.__fields__) for i, r in blocked.items()}


@settings(max_examples=300, deadline=None)
@given(st.lists(st.floats(allow_nan=False, allow_infinity=False, min_value=-1e300, max_value=1e300).filter(lambda x: x == 0 or abs(x) > 1e-290), min_size=1, max_size=8))
def test_exponents_cover_every_bit(values):
    """On exact numbers: each value is a whole multiple of the last 2**e, and less than 2**30 times the first."""
    sizes = [abs(v) for v in values if v]
    exponents = W.digit_exponents(min(sizes), max(sizes)) if sizes else []
    assert all(a - b == W.DIGIT_BITS for a, b in zip(exponents, exponents[1:]))
    for v in map(Fraction, sizes):
        assert (v / Fraction(2) ** exponents[-1]).denominator == 1
        assert v < Fraction(2) ** (exponents[0] + W.DIGIT_BITS)


def test_digits_in_spark_are_those_of_the_rule(spark):
    rng = random.Random(4)
    values = [rng.uniform(-1, 1) * 10.0 ** rng.randint(-40, 40) for _ in range(200)]
    exponents = W.digit_exponents(min(map(abs, values)), max(map(abs, values)))
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for r in df.select("v", *[d.alias(f"d{i}") for i, d in enumerate(W.digits(F.col("v"), exponents))]).collect():
        assert all(abs(r[f"d{i}"]) < 2 ** W.DIGIT_BITS for i in range(len(exponents)))
        assert sum(Fraction(r[f"d{i}"]) * Fraction(2) ** e for i, e in enumerate(exponents)) == Fraction(r["v"])
