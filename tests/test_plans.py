"""Plan properties the scale design depends on, checked on static plans as on a
cluster (AQE off, no size-based broadcast joins)."""

import pytest

from ebbflow.operators import features as FE
from ebbflow.plans import churn

from conftest import SF_MID


@pytest.fixture()
def cluster_like(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    for k, v in old.items():
        spark.conf.set(k, v)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_feature_join_plan(cluster_like):
    plan = _plan(churn.features_base(cluster_like, SF_MID))
    assert "ShuffledHashJoin" in plan and "BuildLeft" in plan          # customers are the build side
    assert "partial_count" in plan                                      # tickets reduced before the shuffle
    assert "BroadcastExchange" not in plan and "CartesianProduct" not in plan


def test_transform_adds_no_shuffle(cluster_like):
    base = churn.cleaned(cluster_like, SF_MID)
    plan = _plan(FE.transform(base, churn.feature_params(cluster_like, SF_MID)))
    assert "Exchange" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_auc_has_no_global_sort(cluster_like):
    from ebbflow.operators.evaluate import roc_auc
    plan = _plan(roc_auc(churn.predictions(cluster_like, SF_MID)))
    # single-partition steps: the bucket-total window (small table) and the final global aggregate
    assert plan.count("Exchange SinglePartition") <= 2
    assert "rangepartitioning" not in plan


def test_hash_build_is_sized_first(spark, monkeypatch):
    from ebbflow.operators import join
    from ebbflow.plans import churn
    tables = churn.source_tables(spark, SF_MID)
    plan = lambda: join.features_base(*tables)._jdf.queryExecution().optimizedPlan().toString()
    assert join.small_per_task(tables[0]) and "strategy=shuffle_hash" in plan()
    monkeypatch.setattr(join, "HASH_BUILD_BYTES", 10)
    assert not join.small_per_task(tables[0]) and "shuffle_hash" not in plan()
