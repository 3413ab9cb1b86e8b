"""Bounded samples by hash order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

BUCKETS = 64


def first_by_hash(rows: DataFrame, group: str, key: str, most: int) -> DataFrame:
    """The ``most`` rows of each ``group`` whose hash of ``key`` is smallest. They are taken
    from each of ``BUCKETS`` parts of a group first, so one task sees ``BUCKETS`` * ``most``
    rows at most, however common the group."""
    h = F.xxhash64(key)
    part = Window.partitionBy(group, F.pmod(h, F.lit(BUCKETS))).orderBy(h, key)
    whole = Window.partitionBy(group).orderBy(h, key)
    few = rows.withColumn("sample_rank", F.row_number().over(part)).where(F.col("sample_rank") <= most).drop("sample_rank")
    return few.withColumn("sample_rank", F.row_number().over(whole)).where(F.col("sample_rank") <= most).drop("sample_rank")
