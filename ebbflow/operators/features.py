"""F1-F6 with A6-A8 and P2-P10: the feature step as a fit/transform pair.

``fit`` computes every statistic the transform needs (medians, modes,
75th-percentile threshold, sorted category lists) in a few full passes and
returns them as a small ``FeatureParams`` value (like a fitted Spark ML model).
``transform`` is a single ``select`` of built-in expressions with those values
as literals, so training and scoring share one encoder (F5): the same params
encode a batch, a stream, or raw labels typed into a form.

Semantics follow the reference: numeric coercion (blank -> missing), median
imputation of the numerical columns, mode imputation (lowest value on ties) of
the binary and categorical columns, average_charges = total / tenure if
tenure > 0 else monthly, rounded half-to-even to 2 decimals, a high-value flag
above the 75th percentile of the (imputed) monthly charges, yes/no and gender
maps (unmapped -> NULL), and codes from the sorted distinct values (unmapped or
missing -> -1).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ebbflow import schemas as S
from ebbflow.functions.scalar import coerce_numeric, flag_above, map_values, round_half_even
from ebbflow.operators import stats
from ebbflow.session import ensure_checkpoint_dir

# Fixed values that must equal the reference: binary and gender maps, the
# percentile of the high-value flag, the rounding digits.
BINARY_MAP = {"Yes": 1, "No": 0, "No phone service": 0, "No internet service": 0}
GENDER_MAP = {"Female": 0, "Male": 1}
HIGH_VALUE_PERCENTILE = 0.75
AVERAGE_DIGITS = 2

# Above this many distinct values a category list is applied with a (hash) join
# instead of a literal array: array_position scans the literal per row.
CATEGORY_LITERAL_LIMIT = 256


@dataclass
class FeatureParams:
    medians: dict = field(default_factory=dict)
    modes: dict = field(default_factory=dict)
    target_median: float | None = None
    high_value_threshold: float | None = None
    categories: dict = field(default_factory=dict)
    category_tables: dict = field(default_factory=dict)
    n_rows: int = 0

    def to_json(self) -> str:
        return json.dumps(self.__dict__, sort_keys=True)

    @classmethod
    def from_json(cls, text: str) -> "FeatureParams":
        return cls(**json.loads(text))

    def encoding_map(self) -> dict:
        return {c: {i: v for i, v in enumerate(vals)} for c, vals in self.categories.items() if vals is not None}


def drop_columns(df: DataFrame, drop: Sequence[str] = S.DROP_COLUMNS, keep: Sequence[str] = (S.KEY,)) -> DataFrame:
    """Drop those of a fixed list that exist (``df.drop`` ignores absent names).
    The key is kept by default as the row identity (the reference drops it)."""
    return df.drop(*[c for c in drop if c not in keep])


def coerce(df: DataFrame, cols: Sequence[str] = ("total_charges",)) -> DataFrame:
    """P4 on the columns that exist."""
    present = set(df.columns)
    return df.withColumns({c: coerce_numeric(c) for c in cols if c in present})


def _present(df: DataFrame, cols: Sequence[str]) -> list[str]:
    have = set(df.columns)
    return [c for c in cols if c in have]


def fit(df: DataFrame, distinct_limit: int = stats.DISTINCT_LIMIT, persist: bool = True,
        approx: bool = False) -> FeatureParams:
    """Fit on a coerced frame (``coerce(drop_columns(features_base))``).

    Four jobs over the input (persisted here unless ``persist=False``, e.g. when
    it is already a written table): a sizing pass (row count, non-null
    and approximate distinct counts), one exact percentile pass for every
    median and the high-value threshold, a per-column summary of the
    value-count table (distinct count and mode) and one read of the category
    lists of the low-cardinality columns. The threshold needs its own pass only
    when monthly charges have gaps (it is taken on the imputed column).
    ``approx=True`` opts into ``percentile_approx`` for medians and threshold."""
    numerical = _present(df, S.NUMERICAL_COLUMNS)
    categorical = _present(df, S.BINARY_COLUMNS + S.CATEGORICAL_COLUMNS)
    encode_cols = _present(df, S.CATEGORICAL_COLUMNS)
    med_cols = numerical + ([S.TARGET] if S.TARGET in df.columns else [])
    cached = df.persist(StorageLevel.MEMORY_AND_DISK) if persist else df
    try:
        size_row = cached.agg(F.count(F.lit(1)).alias("n_rows"),
                              *[F.count(c).alias(f"n_{i}") for i, c in enumerate(med_cols)],
                              *[F.approx_count_distinct(c).alias(f"d_{i}") for i, c in enumerate(med_cols)]).first()
        n_rows = size_row["n_rows"]
        sizes = {c: (size_row[f"n_{i}"], size_row[f"d_{i}"]) for i, c in enumerate(med_cols)}
        monthly_full = "monthly_charges" in df.columns and sizes["monthly_charges"][0] == n_rows
        probs = [0.5, HIGH_VALUE_PERCENTILE] if monthly_full else [0.5]
        q = stats.percentiles(cached, med_cols, probs, distinct_limit=distinct_limit, sizes=sizes,
                              approx=approx) if med_cols else {}
        medians = {c: q[((), c)][0] for c in numerical}
        target_median = q[((), S.TARGET)][0] if S.TARGET in df.columns else None

        counts = stats.value_count_table(cached, categorical).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            summary = counts.groupBy("column").agg(
                F.count(F.lit(1)).alias("k"),
                F.min(F.struct((-F.col("n")).alias("neg_n"), F.col("value"))).alias("b")).collect()
            modes = {c: None for c in categorical}
            modes.update({r["column"]: r["b"]["value"] for r in summary})
            k = {r["column"]: r["k"] for r in summary}
            low = [c for c in encode_cols if k.get(c, 0) <= CATEGORY_LITERAL_LIMIT]
            categories, tables = {c: [] for c in low}, {}
            if low:
                for r in counts.where(F.col("column").isin(low)).select("column", "value").collect():
                    categories[r["column"]].append(r["value"])
            categories = {c: sorted(v) for c, v in categories.items()}
            for c in encode_cols:
                if c not in low:
                    categories[c] = None
                    tables[c] = _write_code_table(counts, c)
        finally:
            counts.unpersist()

        threshold = None
        if monthly_full:
            threshold = q[((), "monthly_charges")][1]
        elif "monthly_charges" in df.columns:
            filled = cached.select(F.coalesce(F.col("monthly_charges"), F.lit(medians.get("monthly_charges")))
                                   .alias("monthly_charges"))
            threshold = stats.percentiles(filled, ["monthly_charges"], [HIGH_VALUE_PERCENTILE],
                                          distinct_limit=distinct_limit, approx=approx)[((), "monthly_charges")][0]
    finally:
        if persist:
            cached.unpersist()
    return FeatureParams(medians=medians, modes=modes, target_median=target_median,
                         high_value_threshold=threshold, categories={c: categories[c] for c in encode_cols},
                         category_tables=tables, n_rows=n_rows)


def _code(c: str, cats: list[str]) -> Column:
    if not cats:
        return F.lit(-1)
    arr = F.array(*[F.lit(v) for v in cats])
    return F.coalesce(F.array_position(arr, F.col(c).cast("string")).cast("int") - 1, F.lit(-1))


def impute(df: DataFrame, params: FeatureParams) -> DataFrame:
    """A6/A8 transform: fill numerical NULLs with medians, categorical with modes."""
    fills: dict[str, Column] = {}
    for c, m in params.medians.items():
        if c in df.columns and m is not None:
            fills[c] = F.coalesce(F.col(c).cast("double"), F.lit(float(m)))
    for c, m in params.modes.items():
        if c in df.columns and m is not None:
            fills[c] = F.coalesce(F.col(c), F.lit(m))
    if S.TARGET in df.columns and params.target_median is not None:
        fills[S.TARGET] = F.coalesce(F.col(S.TARGET), F.rint(F.lit(params.target_median)).cast("int"))
    return df.withColumns(fills)


def engineer(df: DataFrame, params: FeatureParams) -> DataFrame:
    """P7/P8 average charges and P10 high-value flag."""
    out = {}
    if {"tenure_months", "total_charges", "monthly_charges"} <= set(df.columns):
        out["average_charges"] = round_half_even(
            F.when(F.col("tenure_months") > 0, F.col("total_charges") / F.col("tenure_months"))
            .otherwise(F.col("monthly_charges")),
            AVERAGE_DIGITS,
        )
    if "monthly_charges" in df.columns:
        out["high_value_customer"] = flag_above("monthly_charges", params.high_value_threshold)
    return df.withColumns(out)


def encode(df: DataFrame, params: FeatureParams) -> DataFrame:
    """F1 binary, F2 gender, F3 category codes."""
    out = {c: map_values(c, BINARY_MAP, "int") for c in _present(df, S.BINARY_COLUMNS)}
    if "gender" in df.columns:
        out["gender"] = map_values("gender", GENDER_MAP, "int")
    joins = []
    for c, cats in params.categories.items():
        if c not in df.columns:
            continue
        if cats is None:
            joins.append(c)
        else:
            out[c] = _code(c, cats)
    df = df.withColumns(out)
    for c in joins:
        df = _code_by_join(df, c, params.category_tables[c])
    return df


def _write_code_table(counts: DataFrame, c: str) -> str:
    """High-cardinality code map, written once to the shared checkpoint folder so
    that every later transform (batch or stream) reads the same fitted codes."""
    spark = counts.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/ebbflow-codes-{c}-{uuid.uuid4().hex}"
    values = counts.where(F.col("column") == c).select("value")
    stats.ordered_index(values, ["value"], "code").select(
        "value", F.col("code").cast("int").alias("code")).write.mode("overwrite").parquet(path)
    return path


def _code_by_join(df: DataFrame, c: str, path: str) -> DataFrame:
    """Codes of a high-cardinality column joined in from the fitted code table."""
    codes = df.sparkSession.read.parquet(path).toDF(f"_{c}_v", f"_{c}_code")
    j = df.join(codes, F.col(c).cast("string") == F.col(f"_{c}_v"), "left")
    return j.withColumn(c, F.coalesce(F.col(f"_{c}_code"), F.lit(-1))).drop(f"_{c}_v", f"_{c}_code")


def transform(df: DataFrame, params: FeatureParams, key: str | None = S.KEY) -> DataFrame:
    """Impute -> engineer -> encode, then project the 22 features in model order."""
    x = encode(engineer(impute(df, params), params), params)
    cols = ([key] if key and key in x.columns else []) + _present(x, S.FEATURE_COLUMNS)
    if S.TARGET in x.columns:
        cols.append(S.TARGET)
    return x.select(*cols)


def encode_strict(df: DataFrame, params: FeatureParams) -> DataFrame:
    """The key and 22 features of raw rows without imputing: a missing or absent field
    stays NULL (a category code -1), so that the scoring rules see it."""
    have = set(df.columns)
    raw = [c for c in S.FEATURE_COLUMNS if c not in ("average_charges", "high_value_customer")]
    text = {"gender", *S.BINARY_COLUMNS, *S.CATEGORICAL_COLUMNS}
    df = df.withColumns({c: F.lit(None).cast("string" if c in text else "double") for c in raw if c not in have})
    return encode(engineer(coerce(df), params), params).select(S.KEY, *S.FEATURE_COLUMNS)


def category_map(params: FeatureParams, spark: SparkSession) -> DataFrame:
    """F3 output: (column, code, value) rows of the fitted code maps, of whatever size."""
    rows = [(c, i, v) for c, vals in params.categories.items() if vals for i, v in enumerate(vals)]
    out = spark.createDataFrame(rows, "column string, code int, value string")
    for c, path in params.category_tables.items():
        out = out.unionByName(spark.read.parquet(path).select(F.lit(c).alias("column"), "code", "value"))
    return out


def feature_metadata(params: FeatureParams, spark: SparkSession, feature_cols: Sequence[str] = S.FEATURE_COLUMNS) -> DataFrame:
    """one-row metadata frame (names, target, code map, counts). The codes of a column in
    ``code_tables`` are the rows of the table named there."""
    numerical = list(S.NUMERICAL_COLUMNS) + ["average_charges"]
    engineered = ["average_charges", "high_value_customer"]
    schema = T.StructType([
        T.StructField("feature_columns", T.ArrayType(T.StringType())),
        T.StructField("target_column", T.StringType()),
        T.StructField("encoding_map", T.MapType(T.StringType(), T.MapType(T.IntegerType(), T.StringType()))),
        T.StructField("code_tables", T.MapType(T.StringType(), T.StringType())),
        T.StructField("numerical_cols", T.ArrayType(T.StringType())),
        T.StructField("engineered_cols", T.ArrayType(T.StringType())),
        T.StructField("n_rows", T.LongType()),
        T.StructField("n_features", T.IntegerType()),
    ])
    row = (list(feature_cols), S.TARGET, params.encoding_map(), dict(params.category_tables), numerical, engineered, params.n_rows, len(feature_cols))
    return spark.createDataFrame([row], schema)


def encode_raw(df: DataFrame, params: FeatureParams) -> DataFrame:
    """encode raw labelled rows at scoring time with the *fitted* params
    (same maps and threshold as training; no re-fit, no hard-coded values)."""
    return transform(coerce(df), params)
