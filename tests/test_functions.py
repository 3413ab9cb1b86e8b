"""Scalar expressions and the edge cases of FIXTURES.md §4."""

from pyspark.sql import functions as F

from ebbflow.functions.scalar import (coerce_int, coerce_numeric, flag_above, map_values, map_with_default,
                                      risk_level, risk_message, round_half_even, safe_ratio, title_name)
from ebbflow.operators.features import BINARY_MAP


def test_coerce_blank_and_garbage(spark):
    df = spark.createDataFrame([(" ",), ("12.5",), ("x",), (None,), (" 12.5 ",)], "s string")
    got = [r[0] for r in df.select(coerce_numeric("s")).collect()]
    assert got == [None, 12.5, None, None, 12.5]
    assert [r[0] for r in df.select(coerce_int("s")).collect()] == [0, 12, 0, 0, 12]


def test_round_half_even_like_numpy(spark):
    df = spark.createDataFrame([(0.125,), (0.135,), (2.675,), (1.005,)], "x double")
    import numpy as np
    got = [r[0] for r in df.select(round_half_even("x", 2)).collect()]
    assert got == [float(np.round(v, 2)) for v in (0.125, 0.135, 2.675, 1.005)]
    assert got[0] == 0.12


def test_safe_ratio_and_flag(spark):
    df = spark.createDataFrame([(1.0, 0.0), (0.0, 0.0), (4.0, 2.0), (None, 1.0)], "a double, b double")
    assert [r[0] for r in df.select(safe_ratio("a", "b")).collect()] == [None, None, 2.0, None]
    assert [r[0] for r in df.select(flag_above("a", 1.0)).collect()] == [0, 0, 1, 0]


def test_value_maps(spark):
    df = spark.createDataFrame([("Yes",), ("No",), ("No phone service",), ("Maybe",), (None,)], "v string")
    assert [r[0] for r in df.select(map_values("v", BINARY_MAP, "int")).collect()] == [1, 0, 0, None, None]
    assert [r[0] for r in df.select(map_with_default("v", {"Yes": "y"}, "Unknown")).collect()] == \
        ["y", "Unknown", "Unknown", "Unknown", "Unknown"]


def test_risk_bands_edges(spark):
    df = spark.createDataFrame([(0.45, 0), (0.75, 1), (0.74996, 1), (0.1, 0)], "p double, y int")
    rows = df.select(risk_level("p"), risk_message("y", batch=True), risk_message("y", batch=False)).collect()
    assert [r[0] for r in rows] == ["Medium", "High", "Medium", "Low"]
    assert rows[1][1] == "Likely to churn." and rows[0][2] == "Customer is likely to stay."


def test_title_names():
    assert title_name("streaming_tv") == "Streaming Tv"
    assert title_name("support_ticket_count") == "Support Ticket Count"


def test_round_half_up_matches_decimal_rounding(spark):
    from decimal import ROUND_HALF_UP, Decimal
    from hypothesis import given, settings, strategies as st
    from ebbflow.functions.scalar import round_half_up

    @settings(max_examples=5, deadline=None)
    @given(st.lists(st.one_of(st.floats(-1e6, 1e6, allow_nan=False),
                              st.integers(-10**9, 10**9).map(lambda i: i / 10**5)), min_size=50, max_size=300))
    def check(xs):
        df = spark.createDataFrame([(float(x),) for x in xs], "x double")
        got = [r[0] for r in df.select(round_half_up("x", 4)).collect()]
        want = [float(Decimal(repr(float(x))).quantize(Decimal("0.0001"), rounding=ROUND_HALF_UP)) for x in xs]
        assert got == want

    check()
