"""Q1-Q7 and A2/A10: data-quality operators. Each returns a small report frame;
``assert_*`` helpers turn a report into a driver-side failure where the
reference aborts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ebbflow.operators.join import duplicate_keys, orphans


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """A2: one (table_name, n_rows) row per table; the counts run in one job."""
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def min_row_gate(tables: Mapping[str, DataFrame], minimum: Mapping[str, int]) -> DataFrame:
    """Q1: (table_name, n_rows, min_rows, ok) — the limits joined to the counts."""
    counts = table_counts(tables)
    limits = counts.sparkSession.createDataFrame(list(minimum.items()), "table_name string, min_rows bigint")
    return counts.join(F.broadcast(limits), "table_name", "left").select(
        "table_name", "n_rows", "min_rows", (F.col("n_rows") >= F.coalesce("min_rows", F.lit(0))).alias("ok"))


def assert_gate(report: DataFrame) -> None:
    failed = report.where(~F.col("ok")).collect()
    if failed:
        raise ValueError("; ".join(f"table '{r['table_name']}' has only {r['n_rows']} rows, "
                                   f"minimum required is {r['min_rows']}" for r in failed))


def null_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """A10/Q2: (column, n_missing) for every column, one aggregation pass."""
    cols = list(cols or df.columns)
    row = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return row.unpivot([], cols, "column", "n_missing")


def pk_duplicates(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Q4: keys occurring more than once: (table_name, key_value, n_rows)."""
    out = None
    for name, (df, key) in tables.items():
        d = duplicate_keys(df, key).select(F.lit(name).alias("table_name"),
                                          F.col(key).cast("string").alias("key_value"), "n_rows")
        out = d if out is None else out.unionByName(d)
    return out


def fk_orphans(parent: DataFrame, children: Mapping[str, tuple[DataFrame, str]], key: str = "customer_id") -> DataFrame:
    """Q5: child rows without a parent: (table_name, row_id, foreign_key), ids as text."""
    out = None
    for name, (df, row_id) in children.items():
        o = orphans(df, parent, key).select(F.lit(name).alias("table_name"), F.col(row_id).cast("string").alias("row_id"),
                                            F.col(key).cast("string").alias("foreign_key"))
        out = o if out is None else out.unionByName(o)
    return out


# Q3 rules: (column, minimum, maximum, required); fixed values of the scoring input contract.
def scoring_rules(feature_cols: Sequence[str]) -> list[tuple[str, float | None, float | None, bool]]:
    flags = {"gender", "senior_citizen", "partner", "dependents", "phone_service", "online_security",
             "online_backup", "device_protection", "tech_support", "streaming_tv", "streaming_movies",
             "paperless_billing", "high_value_customer"}
    rules = []
    for c in feature_cols:
        if c in flags:
            rules.append((c, 0, 1, True))
        elif c == "support_ticket_count":
            rules.append((c, 0, None, False))  # defaults to 0 when absent
        else:
            rules.append((c, 0, None, True))
    return rules


def violations(rules) -> Column:
    """``ARRAY<STRING>`` of broken rules per row (empty when valid)."""
    checks = []
    for c, lo, hi, required in rules:
        x = F.col(c)
        if required:
            checks.append(F.when(x.isNull(), F.lit(f"{c}: missing")))
        if lo is not None:
            checks.append(F.when(x < lo, F.lit(f"{c}: below {lo}")))
        if hi is not None:
            checks.append(F.when(x > hi, F.lit(f"{c}: above {hi}")))
    return F.filter(F.array(*checks), lambda v: v.isNotNull())


def validate(df: DataFrame, rules) -> DataFrame:
    """Q3: add ``violations`` and ``is_valid``; fill the defaulted ticket count.
    Rows are routed (valid / rejected), never fatal for the batch."""
    if "support_ticket_count" in df.columns:
        df = df.withColumn("support_ticket_count", F.coalesce("support_ticket_count", F.lit(0).cast("long")))
    v = df.withColumn("violations", violations(rules))
    return v.withColumn("is_valid", F.size("violations") == 0)


def assert_not_empty(df: DataFrame) -> None:
    """Q6: a batch must hold at least one row."""
    if df.isEmpty():
        raise ValueError("No customers provided.")


def dominant_columns(value_counts: DataFrame, threshold: float = 0.90) -> DataFrame:
    """Q7: per column, the top value's share; ``dominant`` when share >= threshold."""
    best = value_counts.groupBy("column").agg(
        F.min(F.struct((-F.col("share")).alias("neg"), F.col("value"))).alias("b"))
    return best.select("column", F.col("b.value").alias("top_value"), (-F.col("b.neg")).alias("top_share"),
                       ((-F.col("b.neg")) >= threshold).alias("dominant"))
