"""Sharding: proportional stratified interleaving, with DataFrame functions only.

Rows are shuffled by a seeded hash within their stratum (source); row r of n (from 0)
has the fractional rank (2r + 1) / 2n. In the order of (fractional rank, stratum) every
stretch holds each stratum in proportion to its size, so cutting that order into equal
parts gives shards that match the mixture, with row counts at most one apart.

Neither rank uses a window over a whole stratum or table. Ranks within a stratum are
the rank within a bucket of the hash (4096 per stratum, so a source with a third of all
rows is spread over 4096 groups) plus the rows in earlier buckets; positions in the final
order are the rank within one of 4096 equal ranges of the fractional rank plus the rows
in earlier ranges. Only ids, sizes and checksums move, never texts.

Defined results: a null text has no bytes and the CRC-32 of the empty text; a null source
is a stratum of its own; repeated rows are separate rows; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

#: Hex digits of the hash that name a bucket: 16**3 = 4096 buckets.
BUCKET_DIGITS = 3
RANGES = 4096
ROW_OVERHEAD = 16


def seeded_hash(seed: int, *cols: Column) -> Column:
    """Hex digest that orders rows at random, and equally in every run."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *cols))


def running_before(counts: DataFrame, by: list[str], order: str, n: str, alias: str) -> DataFrame:
    """Sum of ``n`` over the earlier ``order`` values of each group ``by``."""
    w = (Window.partitionBy(*by) if by else Window).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn(alias, F.coalesce(F.sum(n).over(w), F.lit(0)))


def shard(docs: DataFrame, n_shards: int = 40, seed: int = 42, stratum: str = "source") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot of every row of ``docs``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        "doc_id",
        # A prefix keeps null apart from every real value.
        F.when(F.col(stratum).isNull(), "0").otherwise(F.concat(F.lit("1"), F.col(stratum).cast("string"))).alias("stratum"),
        (F.octet_length(text) + F.lit(ROW_OVERHEAD)).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"))
    rows = rows.withColumn("h", seeded_hash(seed, F.coalesce(F.col("doc_id").cast("string"), F.lit("")),
                                            F.col("text_crc32").cast("string")))
    rows = rows.withColumn("bucket", F.substring("h", 1, BUCKET_DIGITS))

    buckets = rows.groupBy("stratum", "bucket").agg(F.count("*").alias("n"))
    buckets = running_before(buckets, ["stratum"], "bucket", "n", "earlier")
    buckets = buckets.withColumn("total", F.sum("n").over(Window.partitionBy("stratum"))).drop("n")
    inside = Window.partitionBy("stratum", "bucket").orderBy("h", "doc_id", "text_crc32", "size")
    ranked = (rows.join(buckets, ["stratum", "bucket"])
              .withColumn("r", F.col("earlier") + F.row_number().over(inside) - 1)
              .withColumn("stretch", F.floor((2 * F.col("r") + 1) * RANGES / (2 * F.col("total"))).cast("int")))

    stretches = ranked.groupBy("stretch").agg(F.count("*").alias("n"))
    # At most RANGES rows.
    stretches = running_before(stretches, [], "stretch", "n", "first")
    stretches = stretches.withColumn("n_rows", F.sum("n").over(Window.partitionBy())).drop("n")
    order = Window.partitionBy("stretch").orderBy((2 * F.col("r") + 1) / (2 * F.col("total")), "stratum", "r")
    placed = ranked.join(stretches, "stretch").withColumn("p", F.col("first") + F.row_number().over(order) - 1)
    # Shard s holds positions ceil(s N / k) to ceil((s + 1) N / k) - 1.
    placed = placed.withColumn("shard", F.expr(f"(p * {n_shards}L) div n_rows").cast("int"))
    begin = F.expr(f"(shard * n_rows + {n_shards - 1}L) div {n_shards}L")
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
                         (F.col("p") - begin).cast("long").alias("slot"))
