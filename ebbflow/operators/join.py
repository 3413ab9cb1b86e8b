"""The customer feature join and key checks.

J1 reproduces the reference's statement

    customers LEFT JOIN payments LEFT JOIN support_tickets
    GROUP BY customer, billing values -> COUNT(ticket_id)

whose group key holds billing *values*, so k identical payment rows multiply
the ticket count by k. Joining first would materialise payments x tickets per
customer (quadratic in a hot customer). Instead both children are aggregated
*before* the join (partial aggregation happens map-side, so a customer holding
a third of all tickets is reduced to one row per task before any shuffle):

    n_pay  = payments.groupBy(id, billing...).count()
    n_tick = tickets.groupBy(id).agg(count(ticket_id))
    support_ticket_count = coalesce(n_pay, 1) * coalesce(n_tick, 0)

Skew: a customer may own very many *distinct* billing rows. The customer x
n_pay join is a left-outer shuffled hash join that *builds* on customers (one
row per key, so each build partition is bounded by the customers it holds) and
streams n_pay: a hot key's rows pass through one by one, nothing is buffered
per key, and customers without payments are emitted from the build side. The
per-customer ticket count (one row per key) is joined last, again as the
non-streamed side. One shuffle per input. The build side holds one shuffle
partition of customers in memory and cannot spill, so the hash join is asked for
only if the planner's size of customers, spread over the shuffle partitions, is at
most ``HASH_BUILD_BYTES`` each; beyond that the planner chooses (sort-merge, which
spills).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

#: Bytes of customers that one task of the hash join may hold.
HASH_BUILD_BYTES = 64 << 20

BILLING_COLUMNS = ("monthly_charges", "total_charges", "payment_method", "paperless_billing")


def planned_bytes(df: DataFrame) -> int:
    """The planner's estimate of a frame's size; no job runs."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def small_per_task(df: DataFrame, most: int | None = None) -> bool:
    """Whether a shuffle partition of ``df`` is planned to hold at most ``most`` bytes."""
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return planned_bytes(df) <= (HASH_BUILD_BYTES if most is None else most) * partitions


def features_base(
    customers: DataFrame,
    payments: DataFrame,
    tickets: DataFrame,
    billing: Sequence[str] = BILLING_COLUMNS,
    key: str = "customer_id",
    count_col: str = "support_ticket_count",
    hash_build_customers: bool | None = None,
) -> DataFrame:
    """``hash_build_customers=False`` leaves the join strategy to the planner
    (sort-merge: the hot key's payment rows are then buffered per key, spillable);
    by default customers are sized first."""
    if hash_build_customers is None:
        hash_build_customers = small_per_task(customers)
    billing = list(billing)
    n_pay = payments.groupBy(key, *billing).agg(F.count(F.lit(1)).alias("_n_pay"))
    n_tick = tickets.groupBy(key).agg(F.count("ticket_id").alias("_n_tick"))
    rows = (customers.hint("shuffle_hash") if hash_build_customers else customers).join(n_pay, key, "left")
    return (
        rows.join(n_tick, key, "left")
        .select(
            *customers.columns,
            *billing,
            (F.coalesce(F.col("_n_pay"), F.lit(1)) * F.coalesce(F.col("_n_tick"), F.lit(0))).alias(count_col),
        )
    )


def orphans(child: DataFrame, parent: DataFrame, key: str = "customer_id") -> DataFrame:
    """Child rows whose foreign key has no parent (NULL keys are orphans too,
    as a NOT NULL foreign key would reject them)."""
    return child.join(parent.select(key), key, "left_anti")


def valid_children(child: DataFrame, parent: DataFrame, key: str = "customer_id") -> DataFrame:
    """Keep child rows whose key exists in the parent (left semi join)."""
    return child.join(parent.select(key), key, "left_semi")


def duplicate_keys(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Q4: keys occurring more than once, with their count."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)
