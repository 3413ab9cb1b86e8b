"""Scoring customer rows.

A linear scorer (``LinearScorer``) is a set of coefficients applied as one
built-in expression, ``p = 1 / (1 + exp(-(b + sum w_i x_i)))``; with fixed coefficients it is the
deterministic scorer the evaluation queries are checked with. Any MLlib model can score through
``score_model`` (``transform`` + ``vector_to_array``).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, functions as F

from ebbflow import schemas as S
from ebbflow.functions.scalar import risk_level, risk_message, round_half_up
from ebbflow.operators.stats import ordered_index

# Class 1 when P(churn) is strictly above 0.5, as the reference's classifiers
# (decision value > 0) and MLlib (probability > threshold) decide.
THRESHOLD = 0.5


@dataclass(frozen=True)
class LinearScorer:
    name: str
    intercept: float
    weights: tuple[tuple[str, float], ...]
    digits: int | None = 6  # scores rounded so that engines agree on ties

    def margin(self) -> Column:
        z = F.lit(float(self.intercept))
        for c, w in self.weights:
            z = z + F.lit(float(w)) * F.col(c)
        return z

    def probability(self) -> Column:
        p = F.lit(1.0) / (F.lit(1.0) + F.exp(-self.margin()))
        return round_half_up(p, self.digits) if self.digits is not None else p

    def sql(self) -> str:
        z = f"CAST({float(self.intercept)!r} AS DOUBLE)"
        for c, w in self.weights:
            z = f"({z} + CAST({float(w)!r} AS DOUBLE) * {c})"
        p = f"(1.0 / (1.0 + exp(-{z})))"
        if self.digits is None:
            return p
        # decimal rounding, as ``functions.round_half_up``
        return f"CAST(round(CAST({p} AS DECIMAL(38,12)), {self.digits}) AS DOUBLE)"


# Deterministic scorers over the 22 features (fixed coefficients, raw feature scale).
BASELINE_SCORER = LinearScorer("logistic_fixed", -1.2, (
    ("contract", -0.5), ("tenure_months", -0.03), ("monthly_charges", 4e-06), ("support_ticket_count", 0.01),
    ("senior_citizen", 0.4), ("paperless_billing", 0.3), ("internet_service", 0.2), ("high_value_customer", 0.25),
    ("partner", -0.2), ("dependents", -0.15), ("tech_support", -0.3), ("online_security", -0.3),
))
TENURE_SCORER = LinearScorer("tenure_only", 0.8, (("tenure_months", -0.04),))
TICKET_SCORER = LinearScorer("tickets_only", -3.5, (("support_ticket_count", 0.04),))
CONTRACT_SCORER = LinearScorer("contract_only", 0.2, (("contract", -0.9), ("paperless_billing", 0.2)))
# Scoring decides and bands on the unrounded probability; only output columns are rounded.
BATCH_SCORER = replace(BASELINE_SCORER, digits=None)
SCORERS = (BASELINE_SCORER, TENURE_SCORER, TICKET_SCORER, CONTRACT_SCORER)


def score(df: DataFrame, scorer: LinearScorer, key: str = S.KEY, label: str | None = S.TARGET,
          threshold: float = THRESHOLD) -> DataFrame:
    """Predictions frame: id, label, probability, prediction (+ fold when present)."""
    p = scorer.probability()
    cols = [F.col(key).alias("id")]
    if label and label in df.columns:
        cols.append(F.col(label).cast("int").alias("label"))
    cols += [p.alias("probability"), (p > threshold).cast("int").alias("prediction")]
    if "fold" in df.columns:
        cols.append(F.col("fold"))
    return df.select(*cols)


def score_model(df: DataFrame, model, key: str = S.KEY, label: str | None = S.TARGET) -> DataFrame:
    """Score with any fitted MLlib pipeline: class and P(churn) per row."""
    from pyspark.ml.functions import vector_to_array
    out = model.transform(df)
    cols = [F.col(key).alias("id")]
    if label and label in df.columns:
        cols.append(F.col(label).cast("int").alias("label"))
    cols += [vector_to_array("probability")[1].alias("probability"), F.col("prediction").cast("int").alias("prediction")]
    if "fold" in df.columns:
        cols.append("fold")
    return out.select(*cols)


def row_index(df: DataFrame, order_cols: str | Sequence[str], index_col: str = "customer_index") -> DataFrame:
    """P20: 0-based position of each row in ``order_cols`` order (keys of any type)."""
    return ordered_index(df, [order_cols] if isinstance(order_cols, str) else order_cols, index_col)


def score_records(preds: DataFrame, digits: int = 4, batch: bool = True) -> DataFrame:
    """Prediction, probability rounded to 4, risk band on the
    unrounded probability, and the message text."""
    return preds.select(
        "*",
        F.col("prediction").alias("churn_prediction"),
        round_half_up("probability", digits).alias("churn_probability"),
        risk_level("probability").alias("churn_risk_level"),
        risk_message("prediction", batch=batch).alias("message"),
    )


def batch_summary(preds: DataFrame, digits: int = 4) -> DataFrame:
    """Total, churned, not churned and the churn rate rounded to 4."""
    return preds.agg(F.count(F.lit(1)).alias("total_customers"),
                     F.coalesce(F.sum("prediction"), F.lit(0)).cast("long").alias("churned_count")).select(
        "total_customers", "churned_count", (F.col("total_customers") - F.col("churned_count")).alias("not_churned_count"),
        round_half_up(F.try_divide(F.col("churned_count").cast("double"), F.col("total_customers")), digits).alias("churn_rate"))


def concat_batches(batches: Sequence[DataFrame]) -> DataFrame:
    """Concatenate same-schema batches by column name."""
    out = batches[0]
    for b in batches[1:]:
        out = out.unionByName(b)
    return out


def from_api_fields(df: DataFrame, feature_cols: Sequence[str] = S.FEATURE_COLUMNS) -> DataFrame:
    """Rows named like the scoring API's fields (``Senior_Citizen``,
    ``Support_Ticket_Count``, ...) renamed to the feature names and put in the
    training order; an absent ticket count defaults to 0."""
    by_lower = {c.lower(): c for c in df.columns}
    cols = []
    for c in feature_cols:
        if c in by_lower:
            cols.append(F.col(by_lower[c]).alias(c))
        elif c == "support_ticket_count":
            cols.append(F.lit(0).cast("long").alias(c))
        else:
            raise ValueError(f"missing scoring field: {c}")
    keep = [F.col(by_lower[k]).alias(k) for k in (S.KEY.lower(),) if k in by_lower]
    return df.select(*keep, *cols)
