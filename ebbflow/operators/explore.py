"""KPI and exploratory aggregates as small result tables."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from ebbflow import schemas as S
from ebbflow.functions.scalar import round_half_even
from ebbflow.operators.stats import small_side


def rate_by_group(df: DataFrame, key: str, target: str = S.TARGET) -> DataFrame:
    """A4: mean target per category, and as a percentage to 1 decimal (half to even).
    Rows with a NULL key are dropped, as pandas ``groupby`` does."""
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("n_customers"), F.avg(F.col(target).cast("double")).alias("churn_rate"))
        .select(key, "n_customers", "churn_rate", round_half_even(F.col("churn_rate") * 100, 1).alias("churn_rate_pct"))
    )


def kpis(df: DataFrame, target: str = S.TARGET) -> DataFrame:
    """A3/A5: total, churned, retained, churn rate (fraction and %); zero rows -> NULL rates."""
    y = F.col(target).cast("long")
    return df.agg(F.count(F.lit(1)).alias("total"), F.coalesce(F.sum(y), F.lit(0)).alias("churned")).select(
        "total", "churned", (F.col("total") - F.col("churned")).alias("retained"),
        F.try_divide(F.col("churned").cast("double"), F.col("total")).alias("churn_rate"),
        F.try_divide(F.col("churned") * 100.0, F.col("total")).alias("churn_rate_pct"),
    )


def value_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, value, n, share) per column, missing excluded, shares of the column's total."""
    from ebbflow.operators.stats import value_count_table
    vc = value_count_table(df, cols)
    # per-column totals as a small aggregate joined back (not a window: a column
    # with many distinct values would land in one task); one row per name in ``cols``
    totals = vc.groupBy("column").agg(F.sum("n").alias("_total"))
    return vc.join(F.broadcast(totals), "column").select("column", "value", "n", (F.col("n") / F.col("_total")).alias("share"))


def correlation_matrix(df: DataFrame, cols: Sequence[str], digits: int = 2) -> DataFrame:
    """Pairwise Pearson (pairwise-complete rows), rounded half-even; a constant
    column gives NULL instead of a divide-by-zero. All unordered pairs in one aggregation."""
    cols = list(cols)
    aggs = []
    for i, a in enumerate(cols):
        for j, b in enumerate(cols[i:], i):
            both = F.col(a).isNotNull() & F.col(b).isNotNull()
            xa, xb = F.when(both, F.col(a).cast("double")), F.when(both, F.col(b).cast("double"))
            aggs.append(F.try_divide(F.covar_pop(xa, xb), F.stddev_pop(xa) * F.stddev_pop(xb)).alias(f"c_{i}_{j}"))
    row = df.agg(*aggs)
    stacked = row.select(F.explode(F.array(*[
        F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), F.col(f"c_{min(i, j)}_{max(i, j)}").alias("r"))
        for i, a in enumerate(cols) for j, b in enumerate(cols)])).alias("e"))
    return stacked.select("e.col_a", "e.col_b", round_half_even(F.col("e.r"), digits).alias("corr"))


def histogram(df: DataFrame, col: str, by: str = S.TARGET, bins: int = 30) -> DataFrame:
    """``bins`` equal-width bins between each group's own min and max; empty
    bins are reported with 0; a constant group gives a single bin. A NULL group is a
    group of its own, as in ``box_stats``."""
    x = df.where(F.col(col).isNotNull()).select(F.struct(F.col(by).alias("by")).alias("_g"), F.col(col).alias("_v"))
    rng = x.groupBy("_g").agg(F.min("_v").alias("mn"), F.max("_v").alias("mx"))
    rng = small_side(rng)  # so that rows are not shuffled on the few groups
    width = F.col("mx") - F.col("mn")
    nb = F.when(width == 0, F.lit(1)).otherwise(F.lit(bins))
    # one row per (group, bin): groups are few, bins fixed -> a bounded frame
    grid = rng.select("_g", "mn", "mx", F.explode(F.sequence(F.lit(0), nb - 1)).alias("bin"))
    binned = x.join(rng, "_g").select("_g", F.when(width == 0, F.lit(0)).otherwise(
        F.least(F.floor((F.col("_v") - F.col("mn")) / width * bins), F.lit(bins - 1))).cast("int").alias("bin"))
    counts = binned.groupBy("_g", "bin").agg(F.count(F.lit(1)).alias("n"))
    step = F.when(width == 0, F.lit(0.0)).otherwise(width / bins)
    return grid.join(counts, ["_g", "bin"], "left").select(
        F.col("_g.by").alias(by), "bin", (F.col("mn") + F.col("bin") * step).alias("bin_start"),
        F.when(width == 0, F.col("mx")).otherwise(F.col("mn") + (F.col("bin") + 1) * step).alias("bin_end"),
        F.coalesce("n", F.lit(0)).alias("n"))


def box_stats(df: DataFrame, col: str, by: str = S.TARGET) -> DataFrame:
    """Per group Q1, median, Q3 (exact, interpolated), 1.5*IQR fences, whisker
    ends (most extreme points inside the fences) and the number of outliers."""
    from ebbflow.operators.stats import grouped_counts, percentiles_of_counts
    counts = grouped_counts(df, col, [by])
    pct = percentiles_of_counts(counts, [0.25, 0.5, 0.75])
    qs = pct.select("_g", F.col("_pct")[0].alias("q1"), F.col("_pct")[1].alias("median"), F.col("_pct")[2].alias("q3"))
    qs = qs.withColumn("iqr", F.col("q3") - F.col("q1")).withColumn(
        "lower_fence", F.col("q1") - 1.5 * F.col("iqr")).withColumn("upper_fence", F.col("q3") + 1.5 * F.col("iqr"))
    x = F.col("_v")
    inside = (x >= F.col("lower_fence")) & (x <= F.col("upper_fence"))
    agg = counts.join(qs, "_g").groupBy("_g").agg(
        F.min(F.when(inside, x)).alias("whisker_low"), F.max(F.when(inside, x)).alias("whisker_high"),
        F.sum(F.when(inside, 0).otherwise(F.col("_n"))).alias("n_outliers"), F.sum("_n").alias("n"))
    out = qs.join(agg, "_g")
    return out.select(F.col("_g")[by].alias(by), *[c for c in out.columns if c != "_g"])


def mean_ci(df: DataFrame, col: str, by: str = S.TARGET, z: float = 1.96) -> DataFrame:
    """Mean and a closed-form 95 % interval per group (the reference's plot
    default bootstraps; documented difference)."""
    g = df.groupBy(by).agg(F.count(col).alias("n"), F.avg(col).alias("mean"), F.stddev_samp(col).alias("sd"))
    se = F.col("sd") / F.sqrt("n")
    return g.select(by, "n", "mean", "sd", (F.col("mean") - z * se).alias("ci_low"), (F.col("mean") + z * se).alias("ci_high"))


#: Replicates of the bootstrap, and the Poisson(1) probabilities of up to 0, 1, 2, ... draws, as
#: whole numbers of 2**32.
REPLICATES = 200
POISSON_LIMITS = [math.floor(sum(math.exp(-1) / math.factorial(j) for j in range(k + 1)) * 2**32) for k in range(9)]


def bootstrap_mean_ci(df: DataFrame, col: str, key: str, by: str = S.TARGET, replicates: int = REPLICATES,
                      level: float = 0.95, seed: int = 42) -> DataFrame:
    """Mean and percentile interval of the bootstrapped mean per group, in one pass.

    In replicate r a row counts as often as a Poisson(1) draw says, taken from 32 bits of
    md5(key-seed-r): the draws follow from the row, so retries and other partitionings give the
    same interval. Partial sums of all replicates are columns of one aggregate, combined map-side;
    what is shuffled is one row per (task, group). Limits are interpolated order statistics of
    the replicate means, with md5 giving four replicates at a time. Rows with a NULL value or key
    take no part; a NULL group is a group of its own; a replicate that draws no row is left out."""
    x = df.where(F.col(col).isNotNull() & F.col(key).isNotNull()).select(
        F.struct(F.col(by).alias("by")).alias("_g"), F.col(key).cast("string").alias("_k"), F.col(col).cast("double").alias("_v"))
    blocks = math.ceil(replicates / 4)
    digests = F.transform(F.sequence(F.lit(0), F.lit(blocks - 1)), lambda b: F.md5(F.concat("_k", F.lit(f"-{seed}-"), b.cast("string"))))
    bits = F.flatten(F.transform(digests, lambda d: F.array(*[F.conv(F.substring(d, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)])))
    draws = F.transform(bits, lambda u: sum((u >= F.lit(p)).cast("int") for p in POISSON_LIMITS))
    x = x.select("_g", "_v", draws.alias("_d"))
    sums = x.groupBy("_g").agg(F.count(F.lit(1)).alias("n"), F.avg("_v").alias("mean"), *[
        F.struct(F.sum(F.col("_d")[r] * F.col("_v")).alias("s"), F.sum(F.col("_d")[r]).alias("n")).alias(f"_r{r}") for r in range(replicates)])
    means = F.array(*[F.try_divide(F.col(f"_r{r}.s"), F.col(f"_r{r}.n")) for r in range(replicates)])
    means = F.array_sort(F.filter(means, lambda m: m.isNotNull()))
    sums = sums.select(F.col("_g.by").alias(by), "n", "mean", means.alias("_m"))

    def at(q: float):
        place = (F.size("_m") - 1) * F.lit(q)
        low = F.floor(place).cast("int")
        first, second = F.get("_m", low), F.get("_m", F.least(low + 1, F.size("_m") - 1))
        return first + (second - first) * (place - low)

    return sums.select(by, "n", "mean", at((1 - level) / 2).alias("ci_low"), at((1 + level) / 2).alias("ci_high"))


def point_sample(df: DataFrame, x: str, y: str, key: str, by: str = S.TARGET, most: int = 100, seed: int = 42) -> DataFrame:
    """The raw points of a scatter plot: the ``most`` rows of each class with the smallest
    md5(key-seed), all if fewer, each with the number of rows it stands for.

    The k-th smallest digest of a class is found on a table of counts by digest prefix, so no
    task ranks a whole class: prefixes below the one that holds the k-th row are kept whole, and
    only that one's few rows are ranked. The sample of a union is the smallest of both samples, and
    it does not depend on partitioning. Rows with a NULL coordinate or key take no part; rows that
    share a key rank by their coordinates; a NULL class is a class of its own."""
    rows = df.where(F.col(x).isNotNull() & F.col(y).isNotNull() & F.col(key).isNotNull()).select(
        F.struct(F.col(by).alias("by")).alias("_g"), F.col(key).alias("_k"), F.col(x).alias("_x"), F.col(y).alias("_y"),
        F.md5(F.concat(F.col(key).cast("string"), F.lit(f"-{seed}"))).alias("_h"))
    rows = rows.withColumn("_p", F.conv(F.substring("_h", 1, 4), 16, 10).cast("int"))
    counts = rows.groupBy("_g", "_p").agg(F.count(F.lit(1)).alias("_n"))  # at most 65,536 prefixes a class
    before = Window.partitionBy("_g").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    places = counts.select("_g", "_p", "_n", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
                           F.sum("_n").over(Window.partitionBy("_g")).alias("_total")).where(F.col("_before") < most)
    near = rows.join(small_side(places), ["_g", "_p"])
    order = Window.partitionBy("_g", "_p").orderBy("_h", "_k", "_x", "_y")
    kept = near.withColumn("_r", F.row_number().over(order) + F.col("_before")).where(F.col("_r") <= most)
    return kept.select(F.col("_g.by").alias(by), F.col("_k").alias(key), F.col("_x").alias(x), F.col("_y").alias(y),
                       (F.col("_total") / F.least(F.col("_total"), F.lit(most))).alias("weight"))


def density_curve(df: DataFrame, col: str, by: str = S.TARGET, bins: int = 512, grid: int = 200, cut: float = 3.0) -> DataFrame:
    """Gaussian kernel density per group (and overall, group -1), Scott's
    bandwidth ``sd * n^(-1/5)``, on ``grid`` points from min - cut*h to max + cut*h.

    The data are binned first (``bins`` per group, a bounded table); each bin
    then contributes to the fixed grid through an array transform, so the work
    after binning is bins x grid per group regardless of the row count.
    ``density_scaled`` is density x (max - min), dimensionless."""
    base = df.where(F.col(col).isNotNull()).select(F.col(by).cast("int").alias("grp"), F.col(col).cast("double").alias("v"))
    both = base.unionByName(base.select(F.lit(-1).alias("grp"), "v"))
    st = both.groupBy("grp").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("mn"), F.max("v").alias("mx"),
                                 F.stddev_samp("v").alias("sd"))
    st = st.withColumn("h", F.col("sd") * F.pow(F.col("n").cast("double"), F.lit(-0.2))).where(F.col("h") > 0)
    st = small_side(st)
    width = F.col("mx") - F.col("mn")
    binned = (both.join(st, "grp")
              .select("grp", F.least(F.floor((F.col("v") - F.col("mn")) / width * bins), F.lit(bins - 1)).cast("int").alias("b"))
              .groupBy("grp", "b").agg(F.count(F.lit(1)).alias("c")))
    lo, hi = F.col("mn") - cut * F.col("h"), F.col("mx") + cut * F.col("h")
    step = (hi - lo) / (grid - 1)
    center = F.col("mn") + (F.col("b") + 0.5) * width / bins
    contrib = (binned.join(st, "grp")
               .select("grp", "n", "h", "mn", "mx", F.posexplode(F.transform(
                   F.sequence(F.lit(0), F.lit(grid - 1)),
                   lambda k: F.col("c") * F.exp(-0.5 * F.pow(((lo + k * step) - center) / F.col("h"), 2)))).alias("k", "w")))
    sqrt2pi = 2.5066282746310002
    dens = contrib.groupBy("grp", "k", "n", "h", "mn", "mx").agg(F.sum("w").alias("s"))
    x = F.col("mn") - cut * F.col("h") + F.col("k") * ((F.col("mx") + cut * F.col("h")) - (F.col("mn") - cut * F.col("h"))) / (grid - 1)
    d = F.col("s") / (F.col("n") * F.col("h") * sqrt2pi)
    return dens.select(F.col("grp").alias(by), "k", x.alias("x"), d.alias("density"),
                       (d * (F.col("mx") - F.col("mn"))).alias("density_scaled"))


def pair_bins(df: DataFrame, x: str, y: str, by: str = S.TARGET, bins: int = 20) -> DataFrame:
    """2-D binned counts per class (the scatter / pair-grid numbers), bins
    between the global min and max of each axis."""
    r = df.agg(F.min(x).alias("xmn"), F.max(x).alias("xmx"), F.min(y).alias("ymn"), F.max(y).alias("ymx")).first()

    def b(c, mn, mx):
        if mn is None or mx == mn:
            return F.lit(0)
        return F.least(F.floor((F.col(c) - F.lit(mn)) / F.lit(mx - mn) * bins), F.lit(bins - 1)).cast("int")

    j = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    return (j.select(by, b(x, r["xmn"], r["xmx"]).alias("bin_x"), b(y, r["ymn"], r["ymx"]).alias("bin_y"))
            .groupBy(by, "bin_x", "bin_y").agg(F.count(F.lit(1)).alias("n")))


def share_of_total(df: DataFrame, key: str) -> DataFrame:
    """Count per category and its share of the total."""
    g = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    total = df.count()
    return g.withColumn("share", F.col("n") / F.lit(total) if total else F.lit(None).cast("double"))


def preview(df: DataFrame, key: str, n: int = 20) -> DataFrame:
    """The first ``n`` rows in key order (a top-n report; the limit is the feature)."""
    return df.orderBy(key).limit(n)


def profile(df: DataFrame) -> DataFrame:
    """(position, column, type, n_rows)."""
    n = df.count()
    spark = df.sparkSession
    return spark.createDataFrame([(i, f.name, f.dataType.simpleString(), n) for i, f in enumerate(df.schema.fields)],
                                 "position int, column string, type string, n_rows bigint")
