"""Exploratory aggregates: FIXTURES.md §4 edge cases."""

import pytest

from ebbflow.operators import explore as EX


def test_constant_column_correlation_is_null(spark):
    df = spark.createDataFrame([(1.0, 5.0, 0), (2.0, 5.0, 1), (3.0, 5.0, 0), (None, 5.0, 1)],
                               "a double, c double, churn_value int")
    m = {(r["col_a"], r["col_b"]): r["corr"] for r in EX.correlation_matrix(df, ["a", "c"]).collect()}
    assert m[("a", "c")] is None and m[("c", "c")] is None and m[("a", "a")] == 1.0


def test_histogram_single_value_single_bin(spark):
    df = spark.createDataFrame([(7.0, 0)] * 5 + [(1.0, 1), (4.0, 1)], "x double, churn_value int")
    h = EX.histogram(df, "x", bins=30).collect()
    zero = [r for r in h if r["churn_value"] == 0]
    assert len(zero) == 1 and zero[0]["n"] == 5 and zero[0]["bin_start"] == 7.0
    one = sorted((r["bin"], r["n"]) for r in h if r["churn_value"] == 1)
    assert len(one) == 30 and one[0] == (0, 1) and one[-1] == (29, 1) and sum(n for _, n in one) == 2


def test_box_stats_and_kpis(spark):
    df = spark.createDataFrame([(float(v), 0) for v in [1, 2, 3, 4, 100]], "x double, churn_value int")
    b = EX.box_stats(df, "x").first()
    assert (b["q1"], b["median"], b["q3"]) == (2.0, 3.0, 4.0)
    assert b["whisker_high"] == 4.0 and b["n_outliers"] == 1
    k = EX.kpis(df.where("false")).first()
    assert k["total"] == 0 and k["churn_rate"] is None


def test_histogram_and_density_do_not_depend_on_the_broadcast(spark, monkeypatch):
    df = spark.createDataFrame([(float(v * v % 17), v % 3) for v in range(60)], "x double, churn_value int")

    def both():
        return sorted(EX.histogram(df, "x", bins=5).collect()), sorted(EX.density_curve(df, "x").collect())

    few = both()
    monkeypatch.setattr(EX, "small_side", lambda side: side)
    many = both()
    assert few[0] == many[0] and len(few[1]) == len(many[1]) == 800
    for a, b in zip(few[1], many[1]):  # sums in another order
        assert tuple(a) == pytest.approx(tuple(b), rel=1e-9)


def _points(spark):
    rows = [(i, None if i % 7 == 0 else i % 2, None if i % 11 == 0 else float(i % 50), float(i)) for i in range(700)]
    return spark.createDataFrame(rows, "id long, g int, x double, y double")


def test_bootstrap_equals_plain_draws_and_keeps_the_null_group(spark):
    import hashlib

    import numpy as np
    from ebbflow.operators.explore import POISSON_LIMITS, bootstrap_mean_ci
    df = _points(spark)
    got = {r["g"]: r for r in bootstrap_mean_ci(df.repartition(5), "x", "id", by="g", replicates=30).collect()}
    assert set(got) == {None, 0, 1}
    rows = df.collect()
    for g, r in got.items():
        own = [x for x in rows if x["g"] == g and x["x"] is not None]
        v = np.array([x["x"] for x in own])
        means = []
        for k in range(30):
            u = [int(hashlib.md5(f"{x['id']}-42-{k // 4}".encode()).hexdigest()[8 * (k % 4):8 * (k % 4) + 8], 16) for x in own]
            n = np.searchsorted(POISSON_LIMITS, u, side="right")
            means.append((n * v).sum() / n.sum())
        assert abs(r["mean"] - v.mean()) < 1e-9 and r["n"] == len(own)
        assert np.allclose([r["ci_low"], r["ci_high"]], np.quantile(means, [0.025, 0.975]))
        half = 1.96 * v.std(ddof=1) / len(v) ** 0.5
        assert 0.5 * half < (r["ci_high"] - r["ci_low"]) / 2 < 1.5 * half
    assert bootstrap_mean_ci(df.limit(0), "x", "id", by="g").count() == 0


def test_point_sample_is_the_smallest_digests(spark):
    import hashlib

    from ebbflow.operators.explore import point_sample
    df = _points(spark)
    got = {}
    for r in point_sample(df.repartition(4), "x", "y", "id", by="g", most=40).collect():
        got.setdefault(r["g"], {})[r["id"]] = r["weight"]
    rows = [r for r in df.collect() if r["x"] is not None]
    for g in (None, 0, 1):
        own = sorted((r["id"] for r in rows if r["g"] == g), key=lambda i: hashlib.md5(f"{i}-42".encode()).hexdigest())
        assert set(got[g]) == set(own[:40]) and abs(sum(got[g].values()) - len(own)) < 1e-6
    assert point_sample(df, "x", "y", "id", by="g", most=1000).count() == len(rows)
    assert point_sample(df.limit(0), "x", "y", "id", by="g").count() == 0


def test_histogram_keeps_the_null_group(spark):
    from ebbflow.operators.explore import histogram
    df = _points(spark)
    sums = {r["g"]: r["n"] for r in histogram(df, "x", by="g").groupBy("g").agg({"n": "sum"}).withColumnRenamed("sum(n)", "n").collect()}
    assert sums == {r["g"]: r["count"] for r in df.where("x is not null").groupBy("g").count().collect()} and None in sums
