"""Exact, distributed statistics used by the fit steps and the evaluation operators.

* ``percentiles``: exact linear-interpolated percentiles (``percentile`` /
  DuckDB ``quantile_cont``). Spark's ``percentile`` keeps a value->count map
  merged in one task; that is bounded by the
  number of *distinct* values. Each column is first sized with
  ``approx_count_distinct``; above ``distinct_limit`` the exact value is found
  by rank selection that narrows a value bracket with ``percentile_approx``
  (rank error <= m/accuracy per round) until it holds few rows, then ranks the
  remaining rows exactly. Only the first round scans the whole input: after it,
  the rows inside some bracket are kept (semi join) and persisted. A bracket held
  by repeated values stops narrowing and is ranked over its distinct values. No
  step holds more than ``final_limit`` rows or the distinct-value map of a
  bounded column in one task. Grouped percentiles go another way for every size:
  (group, value) counts cumulated in range buckets.
* ``modes``: most frequent value, lowest on ties, via partially aggregated
  ``(column, value) -> count`` and a ``min(struct(-count, value))``, which is
  itself a partial aggregate: scale-safe for any cardinality.
* ``prefix_sums``: exclusive running sums over an ordered key, computed in
  parallel: bucket totals (a small table) are cumulated, then each bucket is
  cumulated on its own and offset. A global ``Window.orderBy`` would run in a
  single task.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ebbflow.session import materialize

DISTINCT_LIMIT = 2_000_000
FINAL_LIMIT = 200_000
APPROX_ACCURACY = 10_000
GRID = 1000
MAX_GROUPS = 10_000  # results of ``percentiles`` come to the driver; many groups use percentiles_frame


# ---------------------------------------------------------------------------
# percentiles
# ---------------------------------------------------------------------------

def _positions(n: int, p: float) -> tuple[int, int, float]:
    pos = (n - 1) * p
    lo, hi = int(math.floor(pos)), int(math.ceil(pos))
    return lo, hi, pos


def _interpolate(lo_val: float, hi_val: float, lo: int, hi: int, pos: float) -> float:
    # Same formula as Spark's Percentile: (hi - pos) * lower + (pos - lo) * higher.
    if lo == hi or lo_val == hi_val:
        return lo_val
    return (hi - pos) * lo_val + (pos - lo) * hi_val


def percentiles(
    df: DataFrame,
    cols: Sequence[str],
    probs: Sequence[float],
    by: Sequence[str] = (),
    distinct_limit: int = DISTINCT_LIMIT,
    final_limit: int = FINAL_LIMIT,
    sizes: dict | None = None,
    approx: bool = False,
    accuracy: int = APPROX_ACCURACY,
) -> dict:
    """Exact percentiles of each column (NULLs ignored), optionally per group (then by
    ``percentiles_frame``, brought to the driver).

    ``approx=True`` opts into ``percentile_approx`` (one pass, bounded sketch,
    returns actual elements, rank error <= n / accuracy) instead.

    ``sizes`` ({column: (non-null count, approx distinct)}) lets a caller that
    already sized the columns in its own pass skip the sizing job.

    Returns ``{(group_tuple, column): [value per prob]}``; a group with no
    non-null value gets ``None`` entries. The result is small (groups x columns
    x probs) and is meant to feed literals into a transform.
    """
    by, cols, probs = list(by), list(cols), [float(p) for p in probs]
    if by:
        if approx:
            frame = df.groupBy(*by).agg(*[F.percentile_approx(F.col(c).cast("double"), probs, accuracy).alias(f"{c}_pct")
                                          for c in cols])
        else:
            frame = percentiles_frame(df, cols, probs, by)
        rows = frame.limit(MAX_GROUPS + 1).collect()
        if len(rows) > MAX_GROUPS:
            raise ValueError(f"more than {MAX_GROUPS} groups for the driver: use percentiles_frame")
        return {(tuple(r[b] for b in by), c): list(r[f"{c}_pct"] or [None] * len(probs)) for r in rows for c in cols}
    if approx:
        row = df.agg(*[F.percentile_approx(F.col(c).cast("double"), probs, accuracy).alias(f"p_{i}")
                       for i, c in enumerate(cols)]).first()
        return {((), c): list(row[f"p_{i}"] or [None] * len(probs)) for i, c in enumerate(cols)}
    if sizes is None:
        row = df.agg(*[F.count(c).alias(f"n_{i}") for i, c in enumerate(cols)],
                     *[F.approx_count_distinct(c).alias(f"d_{i}") for i, c in enumerate(cols)]).first()
        sizes = {c: (row[f"n_{i}"], row[f"d_{i}"]) for i, c in enumerate(cols)}
    direct = [c for c in cols if 0 < sizes[c][0] and sizes[c][1] <= distinct_limit]
    hard = [(c, sizes[c][0]) for c in cols if sizes[c][1] > distinct_limit]
    out = {((), c): [None] * len(probs) for c in cols if sizes[c][0] == 0}
    if direct:
        row = df.agg(*[F.percentile(F.col(c).cast("double"), probs).alias(f"p_{i}") for i, c in enumerate(direct)]).first()
        out |= {((), c): list(row[f"p_{i}"]) for i, c in enumerate(direct)}
    if hard:
        targets = []
        for c, n in hard:
            for p in probs:
                lo, hi, _ = _positions(n, p)
                targets += [((), c, lo), ((), c, hi)]
        vals = select_ranks(df, by, sorted(set(targets)), final_limit)
        for c, n in hard:
            res = []
            for p in probs:
                lo, hi, pos = _positions(n, p)
                res.append(_interpolate(vals[((), c, lo)], vals[((), c, hi)], lo, hi, pos))
            out[((), c)] = res
    return out


def grouped_counts(df: DataFrame, col: str, by: Sequence[str]) -> DataFrame:
    """(_g, _v, _n): rows per group and distinct non-null value, written once. ``_g`` is a
    struct of the group columns, so a NULL group is a group like any other."""
    rows = df.where(F.col(col).isNotNull()).select(F.struct(*by).alias("_g"), F.col(col).cast("double").alias("_v"))
    return materialize(rows.groupBy("_g", "_v").agg(F.count(F.lit(1)).alias("_n")), "grouped-counts")


def percentiles_of_counts(counts: DataFrame, probs: Sequence[float]) -> DataFrame:
    """(_g, _pct): exact interpolated percentiles of each group of ``grouped_counts``. Values
    are cumulated in range buckets of all values, so a group of any size is spread over them."""
    from pyspark.ml.feature import Bucketizer
    grid = [i / 256 for i in range(1, 256)]
    q = counts.agg(F.percentile_approx("_v", grid, 2560).alias("q")).first()["q"]
    inner = sorted({x for x in q or [] if math.isfinite(x)}) or [0.0]
    rows = Bucketizer(splits=[-float("inf"), *inner, float("inf")], inputCol="_v", outputCol="_b",
                      handleInvalid="keep").transform(counts)
    rows = prefix_sums(rows, "_v", ["_n"], F.col("_b").cast("int"), partition_cols=["_g"], totals=True)
    aggs, out = [], []
    for i, p in enumerate(probs):
        pos = (F.col("_n_total") - 1) * F.lit(float(p))
        for name, rank in (("lo", F.floor(pos)), ("hi", F.ceil(pos))):
            here = (F.col("_n_before") <= rank) & (rank < F.col("_n_before") + F.col("_n"))
            aggs.append(F.max(F.when(here, F.col("_v"))).alias(f"_{name}_{i}"))
        lo, hi = F.col(f"_lo_{i}"), F.col(f"_hi_{i}")
        out.append(F.when(lo == hi, lo).otherwise((F.ceil(pos) - pos) * lo + (pos - F.floor(pos)) * hi))
    picked = rows.groupBy("_g").agg(F.max("_n_total").alias("_n_total"), *aggs)
    return picked.select("_g", F.array(*out).alias("_pct"))


def percentiles_frame(df: DataFrame, cols: Sequence[str], probs: Sequence[float], by: Sequence[str]) -> DataFrame:
    """Exact per-group percentiles as a DataFrame (one row per group, one array
    column ``<col>_pct`` per column; NULL for a group without values), for any number
    and size of groups: nothing reaches the driver or is gathered in one task."""
    by = list(by)
    out = df.select(F.struct(*by).alias("_g")).distinct()
    for c in cols:
        pct = percentiles_of_counts(grouped_counts(df, c, by), probs).withColumnRenamed("_pct", f"{c}_pct")
        out = out.join(pct, "_g", "left")
    return out.select(*[F.col("_g")[b].alias(b) for b in by], *[f"{c}_pct" for c in cols])


def ordered_index(df: DataFrame, order_cols: Sequence[str], name: str) -> DataFrame:
    """Add ``name``: the 0-based position of each row in the order of ``order_cols`` (any
    types; NULL first; give enough columns to tell rows apart). Rows are range
    partitioned and written, so the partitions are fixed; each is numbered on its own and
    offset by the rows of the partitions before it."""
    order = list(order_cols)
    parts = materialize(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "ordered")
    sizes = parts.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # one row per partition
    first = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    inside = Window.partitionBy("_part").orderBy(*order)
    return parts.join(F.broadcast(first), "_part").select(
        *df.columns, (F.col("_first") + F.row_number().over(inside) - 1).alias(name))


def select_ranks(df: DataFrame, by: Sequence[str], targets: Sequence[tuple], final_limit: int = FINAL_LIMIT,
                 accuracy: int = APPROX_ACCURACY) -> dict:
    """Exact order statistics: value of 0-based rank ``r`` among the non-null
    values of column ``c`` in group ``g``, for each target ``(g, c, r)``.

    Each round joins the long (group, column, value) rows with the small target
    table (one row per target, broadcast: its size is the number of targets),
    keeps rows inside each target's bracket (lo, hi], and moves the bracket to
    approximate percentiles around the wanted rank; the counts below the new
    bracket edges confirm the rank is still inside before the move is kept.
    """
    by = list(by)
    spark = df.sparkSession
    cols = sorted({c for _, c, _ in targets})
    long = df.select(
        *by,
        F.explode(F.array(*[F.struct(F.lit(c).alias("_c"), F.col(c).cast("double").alias("_v")) for c in cols])).alias("_e"),
    ).select(*by, "_e._c", "_e._v").where(F.col("_v").isNotNull())

    state = {t: {"lo": None, "hi": None, "r": t[2], "m": None} for t in targets}
    # initial bracket sizes
    sizes = long.groupBy(*by, "_c").agg(F.count(F.lit(1)).alias("n")).collect()
    size_of = {(tuple(r[b] for b in by), r["_c"]): r["n"] for r in sizes}
    for t, s in state.items():
        s["m"] = size_of[(t[0], t[1])]
    result: dict = {}

    def target_frame(ts):
        rows = []
        for k, t in enumerate(ts):
            s = state[t]
            rows.append((*t[0], t[1], k, s["lo"], s["hi"], s["r"], s["m"]))
        schema = ", ".join([f"`{b}` {df.schema[b].dataType.simpleString()}" for b in by]
                           + ["_c string", "_t int", "_lo double", "_hi double", "_r long", "_m long"])
        return spark.createDataFrame(rows, schema)

    def in_bracket(tf):
        j = long.join(F.broadcast(tf), [*by, "_c"])
        return j.where((F.col("_lo").isNull() | (F.col("_v") > F.col("_lo")))
                       & (F.col("_hi").isNull() | (F.col("_v") <= F.col("_hi"))))

    def shrink(ts):
        """Rows inside any open bracket (a semi join: each row kept once), persisted
        for the next round, so only the first round scans the whole input."""
        tf = target_frame(ts)
        cond = [F.col(f"l.{b}").eqNullSafe(F.col(f"t.{b}")) for b in by] + [
            F.col("l._c") == F.col("t._c"),
            F.col("t._lo").isNull() | (F.col("l._v") > F.col("t._lo")),
            F.col("t._hi").isNull() | (F.col("l._v") <= F.col("t._hi"))]
        cond_all = cond[0]
        for c in cond[1:]:
            cond_all = cond_all & c
        return long.alias("l").join(F.broadcast(tf).alias("t"), cond_all, "left_semi").persist()

    kept = []

    stalled: set = set()
    for _ in range(64):
        open_ts = [t for t in targets if t not in result and t not in stalled and state[t]["m"] > final_limit]
        if not open_ts:
            break
        tf = target_frame(open_ts)
        # percentile_approx needs constant percentages: ask for a fixed grid and
        # pick, per target, the grid points around its relative rank.
        grid = [j / GRID for j in range(GRID + 1)]
        cand = (
            in_bracket(tf).groupBy("_t").agg(F.percentile_approx("_v", grid, accuracy).alias("_q")).collect()
        )
        bounds = {}
        for row in cand:
            s = state[open_ts[row["_t"]]]
            q = s["r"] / s["m"]
            ja = max(0, int(math.floor((q - 2.0 / accuracy) * GRID)))
            jb = min(GRID, int(math.ceil((q + 2.0 / accuracy) * GRID)))
            bounds[row["_t"]] = (float(row["_q"][ja]), float(row["_q"][jb]))
        bf = spark.createDataFrame(
            [(k, a, b) for k, (a, b) in bounds.items()], "_t int, _a double, _b double"
        )
        counts = (
            in_bracket(tf).join(F.broadcast(bf), "_t")
            .groupBy("_t")
            .agg(F.count_if(F.col("_v") <= F.col("_a")).alias("ca"),
                 F.count_if(F.col("_v") <= F.col("_b")).alias("cb"),
                 F.min(F.when(F.col("_v") > F.col("_a"), F.col("_v"))).alias("mn"),
                 F.max(F.when(F.col("_v") <= F.col("_b"), F.col("_v"))).alias("mx"))
            .collect()
        )
        for row in counts:
            t = open_ts[row["_t"]]
            s = state[t]
            a, b = bounds[row["_t"]]
            ca, cb = row["ca"], row["cb"]
            lo_ok, hi_ok = ca <= s["r"], cb >= s["r"] + 1
            new_lo, new_hi = (a if lo_ok else s["lo"]), (b if hi_ok else s["hi"])
            below = ca if lo_ok else 0
            top = cb if hi_ok else s["m"]
            if lo_ok and hi_ok and row["mn"] is not None and row["mn"] == row["mx"]:
                result[t] = row["mn"]  # the bracket holds a single repeated value
                continue
            if not lo_ok and not hi_ok:
                raise RuntimeError("approximate bracket lost the target rank")
            if (new_lo, new_hi, top - below) == (s["lo"], s["hi"], s["m"]):
                # no progress: the bracket is held by repeated values; the exact final
                # step ranks its *distinct* values, which are then few
                stalled.add(t)
                continue
            s.update(lo=new_lo, hi=new_hi, r=s["r"] - below, m=top - below)
        still = [t for t in targets if t not in result]
        if still:
            long = shrink(still)
            kept.append(long)
    rest = [t for t in targets if t not in result]
    if rest:
        tf = target_frame(rest)
        counted = in_bracket(tf).groupBy("_t", "_r", "_v").agg(F.count(F.lit(1)).alias("_n"))
        w = Window.partitionBy("_t").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        picked = (
            counted.withColumn("_cum", F.sum("_n").over(w))
            .where((F.col("_cum") > F.col("_r")) & (F.col("_cum") - F.col("_n") <= F.col("_r")))
            .select("_t", "_v")
            .collect()
        )
        for row in picked:
            result[rest[row["_t"]]] = row["_v"]
    for k in kept:
        k.unpersist()
    return result


# ---------------------------------------------------------------------------
# modes and distinct values
# ---------------------------------------------------------------------------

def value_count_table(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, value, n) for every non-null value of each column, as text.
    One pass, partially aggregated before the shuffle."""
    return (
        df.select(F.explode(F.array(*[
            F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols
        ])).alias("_e"))
        .select("_e.column", "_e.value")
        .where(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def modes_from_counts(counts: DataFrame) -> DataFrame:
    """Most frequent value per column, the lowest value on a tie."""
    best = counts.groupBy("column").agg(F.min(F.struct((-F.col("n")).alias("neg_n"), F.col("value"))).alias("b"))
    return best.select("column", F.col("b.value").alias("mode"), (-F.col("b.neg_n")).alias("n"))


def modes(df: DataFrame, cols: Sequence[str]) -> dict:
    rows = modes_from_counts(value_count_table(df, cols)).collect()
    out = {c: None for c in cols}
    out.update({r["column"]: r["mode"] for r in rows})
    return out


# ---------------------------------------------------------------------------
# prefix sums
# ---------------------------------------------------------------------------

def prefix_sums(
    df: DataFrame,
    order_col: str,
    sum_cols: Sequence[str],
    bucket: Column,
    partition_cols: Sequence[str] = (),
    descending: bool = False,
    suffix: str = "_before",
    totals: bool = False,
) -> DataFrame:
    """Add ``<c><suffix>``: sum of ``c`` over rows of the same partition that come
    strictly before this row in ``order_col`` order (``descending`` flips it).

    A NULL partition value is a partition of its own.

    ``order_col`` must be unique within a partition (aggregate first) and
    ``bucket`` a non-decreasing integer function of it, with a bounded range
    (e.g. ``floor(score * 65536)``): the bucket-total table has at most
    partitions x buckets rows and is the only input of the global cumulation.
    With ``totals`` each row also gets ``<c>_total`` (the partition's sum), taken
    from the same small bucket table.
    """
    # one struct key: it is never NULL, so a NULL partition value joins like any other
    parts = ["_part"]
    x = df.withColumn("_bk", bucket).withColumn("_part", F.struct(F.lit(0).alias("_"), *partition_cols))
    tot = x.groupBy(*parts, "_bk").agg(*[F.sum(c).alias(c) for c in sum_cols])
    border = F.col("_bk").desc() if descending else F.col("_bk").asc()
    wb = Window.partitionBy(*parts).orderBy(border).rowsBetween(Window.unboundedPreceding, -1)
    wt = Window.partitionBy(*parts)
    offsets = tot.select(*parts, "_bk", *[F.coalesce(F.sum(c).over(wb), F.lit(0)).alias(f"_o_{c}") for c in sum_cols],
                         *([F.sum(c).over(wt).alias(f"{c}_total") for c in sum_cols] if totals else []))
    korder = F.col(order_col).desc() if descending else F.col(order_col).asc()
    wi = Window.partitionBy(*parts, "_bk").orderBy(korder).rowsBetween(Window.unboundedPreceding, -1)
    joined = x.join(offsets, [*parts, "_bk"])
    return joined.select(
        *df.columns,
        *[(F.col(f"_o_{c}") + F.coalesce(F.sum(c).over(wi), F.lit(0))).alias(f"{c}{suffix}") for c in sum_cols],
        *([f"{c}_total" for c in sum_cols] if totals else []),
    )


def score_bucket(score: str | Column, n_buckets: int = 1 << 16, lo: float = 0.0, hi: float = 1.0) -> Column:
    """Bucket of a score in [lo, hi] (clamped), non-decreasing in the score."""
    s = F.col(score) if isinstance(score, str) else score
    scaled = (s - F.lit(float(lo))) / F.lit(float(hi - lo)) if (lo, hi) != (0.0, 1.0) else s
    return F.least(F.greatest(F.floor(scaled * n_buckets), F.lit(0)), F.lit(n_buckets - 1)).cast("int")


def quantile_bucket(df: DataFrame, score: str, values: DataFrame, n_buckets: int = 1024) -> DataFrame:
    """``df`` with ``_bucket``: the quantile range of ``score`` among the rows of ``values``,
    so scores that lie close together are spread over as many tasks as even ones. The range
    limits are one approximate aggregate (a few KB); the sums built on them stay exact."""
    from pyspark.ml.feature import Bucketizer

    grid = [k / n_buckets for k in range(1, n_buckets)]
    row = values.agg(F.percentile_approx(F.col(score).cast("double"), grid, 10 * n_buckets)).first()
    limits = sorted({x for x in row[0] or [] if math.isfinite(x)}) or [0.0]
    return Bucketizer(splits=[-math.inf, *limits, math.inf], inputCol=score, outputCol="_bucket",
                      handleInvalid="keep").transform(df)


#: Rows up to which a table of one row per group is broadcast.
SMALL_GROUPS = 10_000


def small_side(df: DataFrame, most: int = SMALL_GROUPS) -> DataFrame:
    """``df`` marked for a broadcast if it has at most ``most`` rows, else ``df`` itself (a
    shuffled join, whose skewed keys adaptive execution splits). Results are the same."""
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        return df
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))
