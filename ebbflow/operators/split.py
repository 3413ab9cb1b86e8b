"""M1-M4: deterministic stratified split, stratified folds, standardisation, class weights.

Order inside each class is a hash of the key and a seed (``md5(key || '-' || seed)``),
so the split is reproducible across engines and reruns (executor loss included).
The per-class rank is computed in parallel: counts per (class, hash-bucket) form
a small table (classes x 65,536 rows) that is cumulated, and each bucket ranks
only its own rows. Class sizes of the split follow the reference's stratified
allocation: test = ceil(0.2 n); train sizes per class by largest remainder first,
test sizes from what remains (ties go to the lower class value).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ebbflow import schemas as S
from ebbflow.operators.stats import prefix_sums

# Fixed values that must equal the reference: seed, test share, number of folds.
SEED = 42
TEST_SIZE = 0.2
N_FOLDS = 5


def hash_order(key: str | Column, seed: int = SEED) -> Column:
    k = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(F.coalesce(k.cast("string"), F.lit("")), F.lit(f"-{seed}")))


def approximate_mode(counts: dict, n_draws: int) -> dict:
    """Spread ``n_draws`` over classes in proportion to ``counts``: floors, then
    the largest remainders (lower class first on equal remainders)."""
    total = sum(counts.values())
    cont = {c: counts[c] * n_draws / total for c in counts}
    fl = {c: math.floor(v) for c, v in cont.items()}
    need = n_draws - sum(fl.values())
    for c in sorted(counts, key=lambda c: (-(cont[c] - fl[c]), c is not None, c or 0))[:max(need, 0)]:
        fl[c] += 1
    return fl


def allocation(counts: dict, test_size: float = TEST_SIZE) -> tuple[dict, dict]:
    n = sum(counts.values())
    n_test = math.ceil(test_size * n)
    train = approximate_mode(counts, n - n_test)
    test = approximate_mode({c: counts[c] - train[c] for c in counts}, n_test)
    return train, test


def class_ranks(df: DataFrame, key: str = S.KEY, label: str = S.TARGET, seed: int = SEED) -> DataFrame:
    """Add ``_rank``: 0-based position of the row inside its class in hash order."""
    h = df.withColumn("_h", hash_order(key, seed)).withColumn("_one", F.lit(1))
    bucket = F.conv(F.substring("_h", 1, 4), 16, 10).cast("int")
    # hash + key is unique among distinct keys; prefix_sums needs a unique order column
    h = h.withColumn("_hk", F.concat("_h", F.lit(":"), F.coalesce(F.col(key).cast("string"), F.lit(""))))
    r = prefix_sums(h, "_hk", ["_one"], bucket, partition_cols=[label], suffix="_before")
    return r.withColumnRenamed("_one_before", "_rank").drop("_h", "_one", "_hk")


def split_assign(df: DataFrame, key: str = S.KEY, label: str = S.TARGET, seed: int = SEED,
                 test_size: float = TEST_SIZE, n_folds: int = N_FOLDS) -> DataFrame:
    """Add ``split`` ('train'/'test') and ``fold`` (0..n_folds-1 for train rows, NULL for test).

    Keys are assigned, not rows: all rows of one key (a customer with several billing
    rows) lie on one side and in one fold. NULL labels are a class of their own, NULL keys one key. Train keys of a class are cut into ``n_folds`` consecutive hash-order
    ranges, so per-class fold sizes differ by at most one."""
    keys = df.select(key, label).distinct()
    counts = {r[label]: r["n"] for r in keys.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return df.withColumn("split", F.lit(None).cast("string")).withColumn("fold", F.lit(None).cast("int"))
    train, test = allocation(counts, test_size)
    def of_class(sizes: dict):
        known = {c: n for c, n in sizes.items() if c is not None}
        found = F.create_map(*[x for c, n in known.items() for x in (F.lit(c), F.lit(n))])[F.col(label)] if known else F.lit(None).cast("int")
        return F.when(F.col(label).isNull(), F.lit(sizes.get(None, 0))).otherwise(found)

    n_test, n_train = of_class(test), of_class(train)
    r = class_ranks(keys, key, label, seed)
    is_test = F.col("_rank") < n_test
    fold = F.when(~is_test, F.floor((F.col("_rank") - n_test) * n_folds / n_train).cast("int"))
    r = r.select(F.col(key).alias("_key"), F.col(label).alias("_label"),
                 F.when(is_test, "test").otherwise("train").alias("split"), fold.alias("fold"))
    return df.join(r, F.col(key).eqNullSafe(F.col("_key")) & F.col(label).eqNullSafe(F.col("_label"))).drop("_key", "_label")


def scaling(src: DataFrame, cols: Sequence[str]) -> list[tuple[float, float]]:
    """(mean, population std) of each column in one pass; a constant column gets scale 1."""
    st = src.agg(*[F.avg(c).alias(f"m_{i}") for i, c in enumerate(cols)],
                 *[F.stddev_pop(c).alias(f"s_{i}") for i, c in enumerate(cols)]).first()
    return [(st[f"m_{i}"], st[f"s_{i}"] or 1.0) for i in range(len(cols))]


def standardize(df: DataFrame, cols: Sequence[str], fit_on: Column | None = None, suffix: str = "") -> DataFrame:
    """M3: (x - mean) / population std, statistics from the rows selected by
    ``fit_on`` (the training rows); a constant column gets scale 1, as the
    reference's scaler does. One aggregation pass for all columns."""
    src = df.where(fit_on) if fit_on is not None else df
    return df.withColumns({c + suffix: (F.col(c) - F.lit(m)) / F.lit(s) for c, (m, s) in zip(cols, scaling(src, cols))})


def class_weights(df: DataFrame, label: str = S.TARGET) -> DataFrame:
    """M4: balanced weights n / (n_classes * n_c) per class."""
    g = df.groupBy(label).agg(F.count(F.lit(1)).alias("n_class"))
    w = Window.partitionBy()
    return g.select(label, "n_class",
                    (F.sum("n_class").over(w) / (F.count(F.lit(1)).over(w) * F.col("n_class"))).alias("weight"))


def with_weights(df: DataFrame, label: str = S.TARGET, weight_col: str = "weight", positive_weight: float | None = None) -> DataFrame:
    """Per-row weight column (balanced, or a fixed positive-class weight)."""
    if positive_weight is not None:
        return df.withColumn(weight_col, F.when(F.col(label) == 1, F.lit(float(positive_weight))).otherwise(F.lit(1.0)))
    rows = class_weights(df, label).collect()
    m = F.create_map(*[x for r in rows for x in (F.lit(r[label]), F.lit(float(r["weight"])))])
    return df.withColumn(weight_col, m[F.col(label)])
