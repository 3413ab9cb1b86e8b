"""Repeatable appends and keyed upserts behind a manifest."""

from datetime import datetime

import pytest
from pyspark.sql import types as T

from ebbflow.sources.managed import ManagedTable

SCHEMA = T.StructType([T.StructField("no", T.LongType()), T.StructField("k", T.StringType()), T.StructField("v", T.IntegerType()),
                       T.StructField("w", T.StringType()), T.StructField("created_at", T.TimestampType()), T.StructField("updated_at", T.TimestampType())])
DAY = [datetime(2026, 1, d) for d in range(1, 9)]


def rows(table):
    return {r["k"]: r.asDict() for r in table.read().collect()}


def table_of(spark, tmp_path, **options):
    return ManagedTable(spark, f"{tmp_path}/t", SCHEMA, key="k", surrogate="no", defaults={"v": 0}, n_parts=4, **options)


def test_a_batch_counts_once(spark, tmp_path):
    t = ManagedTable(spark, f"{tmp_path}/a", T.StructType([T.StructField("x", T.LongType())]))
    assert t.read().count() == 0 and t.manifest() == {}
    t.put("one", spark.range(10).toDF("x"))
    t.stage(spark.range(5).toDF("x"))  # a run that ends before its manifest row
    t.put("two", spark.range(3).toDF("x"))
    assert t.read().count() == 13
    t.put("one", spark.range(4).toDF("x"))  # the batch again, with other rows
    assert t.read().count() == 7 and t.version() == 3
    t.put("none", spark.range(0).toDF("x"))
    assert t.read().count() == 7


def test_a_second_writer_of_a_version_fails(spark, tmp_path):
    t = ManagedTable(spark, f"{tmp_path}/a", T.StructType([T.StructField("x", T.LongType())]))
    t.put("one", spark.range(2).toDF("x"))
    with pytest.raises(Exception, match="(?i)exists"):
        t.commit({"batch-two": (t.stage(spark.range(9).toDF("x")), 9)}, version=1)
    assert t.read().count() == 2


def test_audit_stamps_defaults_and_generated_keys(spark, tmp_path):
    t = table_of(spark, tmp_path)
    first = spark.createDataFrame([(f"k{i}", f"w{i}") for i in range(20)], "k string, w string")
    assert t.upsert(first, DAY[0]) == {"inserted": 20, "updated": 0}
    got = rows(t)
    assert sorted(r["no"] for r in got.values()) == list(range(1, 21)) and {r["v"] for r in got.values()} == {0}
    more = spark.createDataFrame([("k3", 7, "w3"), ("k4", None, "new"), ("k5", 0, "w5"), ("z", 1, None), ("y", 2, "b")], "k string, v int, w string")
    assert t.upsert(more, DAY[1]) == {"inserted": 2, "updated": 2}
    now = rows(t)
    assert len(now) == 22 and {k: now[k]["no"] for k in ("y", "z")} == {"y": 21, "z": 22}
    for k, r in now.items():
        moved = k in ("k3", "k4", "y", "z")
        assert r["created_at"] == (DAY[1] if k in "yz" else DAY[0]) and r["updated_at"] == (DAY[1] if moved else DAY[0])
    assert (now["k3"]["v"], now["k4"]["v"], now["k4"]["w"], now["z"]["w"], now["k7"]["w"]) == (7, 0, "new", None, "w7")
    before = t.version()
    assert t.upsert(more, DAY[2]) == {"inserted": 0, "updated": 0} and rows(t) == now and t.version() == before
    assert all(now[k]["no"] == got[k]["no"] for k in got)  # a generated key never changes


def test_repeated_null_and_missing_keys(spark, tmp_path):
    t = table_of(spark, tmp_path)
    twice = spark.createDataFrame([("a", 1, "x"), ("a", 2, "b"), ("a", 2, "c")], "k string, v int, w string")
    assert t.upsert(twice, DAY[0])["inserted"] == 1 and (rows(t)["a"]["v"], rows(t)["a"]["w"]) == (2, "c")
    with pytest.raises(ValueError, match="without k"):
        t.upsert(spark.createDataFrame([(None, 1)], "k string, v int"), DAY[1])
    with pytest.raises(ValueError, match="no column k"):
        t.upsert(spark.createDataFrame([(1,)], "v int"), DAY[1])
    assert t.upsert(twice.limit(0), DAY[1]) == {"inserted": 0, "updated": 0} and len(rows(t)) == 1
