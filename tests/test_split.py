"""Stratified split and folds: exact class sizes, balance, determinism."""

from pyspark.sql import functions as F

from ebbflow.operators.split import allocation, class_weights, split_assign


def test_allocation_reference_sizes():
    train, test = allocation({0: 5174, 1: 1869})
    assert test == {0: 1035, 1: 374} and sum(test.values()) == 1409
    assert train == {0: 4139, 1: 1495}


def test_split_properties(spark):
    rows = [(i, int(i % 7 == 0 or i % 11 == 0)) for i in range(2000)]
    df = spark.createDataFrame(rows, "customer_id long, churn_value int")
    s = split_assign(df).persist()
    counts = {(r["churn_value"], r["split"]): r["n"] for r in s.groupBy("churn_value", "split").count().withColumnRenamed("count", "n").collect()}
    n1 = sum(1 for _, y in rows if y == 1)
    _, test = allocation({0: 2000 - n1, 1: n1})
    assert counts[(0, "test")] == test[0] and counts[(1, "test")] == test[1]
    assert s.where(F.col("split") == "test").where(F.col("fold").isNotNull()).count() == 0
    folds = s.where(F.col("split") == "train").groupBy("churn_value", "fold").count().collect()
    for y in (0, 1):
        sizes = [r["count"] for r in folds if r["churn_value"] == y]
        assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1
    again = split_assign(df)
    assert sorted(map(tuple, s.select("customer_id", "split", "fold").collect())) == \
        sorted(map(tuple, again.select("customer_id", "split", "fold").collect()))


def test_split_by_customer(spark):
    """All rows of a customer lie on one side and in one fold."""
    rows = [(f"C-{i % 301}", int(i % 301 % 4 == 0), i) for i in range(2000)]
    s = split_assign(spark.createDataFrame(rows, "customer_id string, churn_value int, amount int"))
    places = s.groupBy("customer_id").agg(F.countDistinct("split").alias("a"), F.countDistinct("fold").alias("b"))
    assert s.count() == 2000 and places.where("a <> 1 or b > 1").count() == 0
    test = s.where("split = 'test'").select("customer_id").distinct().count()
    assert test == 61  # ceil(0.2 * 301)


def test_class_weights(spark):
    df = spark.createDataFrame([(i, int(i < 25)) for i in range(100)], "customer_id long, churn_value int")
    w = {r["churn_value"]: r["weight"] for r in class_weights(df).collect()}
    assert w == {0: 100 / (2 * 75), 1: 100 / (2 * 25)}


def test_allocation_properties():
    from hypothesis import given, settings, strategies as st
    from ebbflow.operators.split import approximate_mode

    @settings(max_examples=300, deadline=None)
    @given(st.dictionaries(st.integers(0, 9), st.integers(1, 10_000), min_size=1, max_size=6), st.floats(0.01, 0.99))
    def check(counts, frac):
        n = sum(counts.values())
        draws = int(frac * n)
        got = approximate_mode(counts, draws)
        assert sum(got.values()) == draws
        for c in counts:
            assert abs(got[c] - counts[c] * draws / n) < 1.0 + 1e-9
            assert 0 <= got[c] <= counts[c]
        train, test = allocation(counts, frac)
        import math
        assert sum(test.values()) == math.ceil(frac * n)
        assert all(train[c] + test[c] == counts[c] for c in counts)

    check()


def test_null_labels_and_keys_are_kept(spark):
    from ebbflow.operators.split import split_assign
    rows = [(i, None if i % 10 == 0 else i % 2) for i in range(200)] + [(None, 1), (None, 1), (None, None)]
    got = split_assign(spark.createDataFrame(rows, "k long, y int"), key="k", label="y").collect()
    assert len(got) == len(rows) and all(r["split"] for r in got)
    for y in (None, 0, 1):
        own = [r for r in got if r["y"] == y]
        assert 0.15 < sum(r["split"] == "test" for r in own) / len(own) < 0.3
        assert {r["fold"] for r in own if r["split"] == "train"} == set(range(5))


def test_null_groups_in_prefix_sums(spark):
    from ebbflow.operators.evaluate import roc_auc
    rows = [(i, None if i % 4 == 0 else "a", i % 2 if i % 3 else 1, i / 100) for i in range(100)]
    df = spark.createDataFrame(rows, "id int, g string, label int, probability double")
    got = {r["g"]: r["roc_auc"] for r in roc_auc(df, by=["g"]).collect()}
    assert set(got) == {None, "a"}
    own = [(r[2], r[3]) for r in rows if r[1] is None]
    pos, neg = [p for y, p in own if y], [p for y, p in own if not y]
    assert abs(got[None] - sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))) < 1e-9
