"""Exact percentiles (both paths), modes and parallel prefix sums against brute force."""

import random

import numpy as np
from pyspark.sql import functions as F

from ebbflow.operators import stats


def test_percentile_small_case(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (2.0,), (4.0,)], "x double")
    assert stats.percentiles(df, ["x"], [0.75])[((), "x")] == [2.5]
    assert stats.percentiles(df, ["x"], [0.75], distinct_limit=0, final_limit=1)[((), "x")] == [2.5]


def test_rank_selection_matches_direct(spark):
    rnd = random.Random(7)
    rows = [(rnd.randint(0, 2), float(rnd.randint(0, 5000)) / 7.0 if rnd.random() > 0.05 else None) for _ in range(6000)]
    df = spark.createDataFrame(rows, "g int, x double")
    probs = [0.0, 0.25, 0.5, 0.75, 0.9, 1.0]
    direct = stats.percentiles(df, ["x"], probs, by=["g"])
    narrowed = stats.percentiles(df, ["x"], probs, by=["g"], distinct_limit=0, final_limit=50)
    for key, vals in direct.items():
        assert narrowed[key] == vals
        g = key[0][0]
        xs = np.array(sorted(r[1] for r in rows if r[0] == g and r[1] is not None))
        assert np.allclose(vals, np.quantile(xs, probs), rtol=0, atol=1e-9)


def test_modes_tie_lowest(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), ("b",), (None,), (None,), (None,)], "v string")
    assert stats.modes(df, ["v"]) == {"v": "a"}


def test_prefix_sums_brute_force(spark):
    rnd = random.Random(3)
    rows = [(rnd.randint(0, 1), round(rnd.random(), 3), rnd.randint(0, 9)) for _ in range(3000)]
    df = spark.createDataFrame(rows, "g int, s double, v int").groupBy("g", "s").agg(F.sum("v").alias("v"))
    agg = {(r["g"], r["s"]): r["v"] for r in df.collect()}
    for desc in (False, True):
        out = stats.prefix_sums(df, "s", ["v"], stats.score_bucket("s", 64), partition_cols=["g"], descending=desc)
        for r in out.collect():
            exp = sum(v for (g, s), v in agg.items() if g == r["g"] and ((s > r["s"]) if desc else (s < r["s"])))
            assert r["v_before"] == exp


def test_approx_percentiles_opt_in(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1001)], "x double")
    assert stats.percentiles(df, ["x"], [0.5], approx=True)[((), "x")] == [500.0]


def test_grouped_percentiles_of_any_size_and_null_group(spark):
    """More groups than the driver takes, mixed sizes, a NULL group and a group without values."""
    rows = [(i // 2, float(i % 7)) for i in range(22_000)] + [(None, float(v)) for v in range(5000)] + [(-1, None)]
    df = spark.createDataFrame(rows, "g int, x double")
    got = {r["g"]: r["x_pct"] for r in stats.percentiles_frame(df, ["x"], [0.25, 0.5], ["g"]).collect()}
    assert len(got) == 11_002 and got[-1] is None and list(got[None]) == [1249.75, 2499.5]
    assert all(list(got[k]) == list(np.quantile([2 * k % 7, (2 * k + 1) % 7], [0.25, 0.5])) for k in range(0, 11_000, 97))


def test_percentiles_frame_matches_dict(spark):
    df = spark.createDataFrame([(g, float(v)) for g in range(3) for v in range(g * 10, g * 10 + 7)], "g int, x double")
    d = stats.percentiles(df, ["x"], [0.25, 0.5], by=["g"])
    f = {r["g"]: list(r["x_pct"]) for r in stats.percentiles_frame(df, ["x"], [0.25, 0.5], ["g"]).collect()}
    assert all(d[((g,), "x")] == f[g] for g in range(3))
