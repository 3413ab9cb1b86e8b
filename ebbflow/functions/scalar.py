"""Column-expression helpers. All are built-in Spark expressions: they stay in
whole-stage codegen and need no Python at execution time."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

__all__ = [
    "col_of", "coerce_numeric", "coerce_int", "clean_string", "round_half_even", "safe_ratio",
    "flag_above", "map_values", "map_with_default", "risk_level", "risk_message",
    "title_name", "title_names", "round_half_up",
]


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def coerce_numeric(c: str | Column, to: str = "double") -> Column:
    """Unparsable text -> NULL (``' '`` -> NULL, ``' 12.5 '`` -> 12.5, ``'x'`` -> NULL).

    ``try_cast`` instead of ``cast``: ANSI mode raises on bad input. The text ``NaN`` is missing
    too, so that it is imputed and moves no order statistic."""
    out = col_of(c).try_cast(to)
    return F.when(~F.isnan(out), out) if to in ("double", "float") else out


def coerce_int(c: str | Column, default: int = 0, to: str = "long") -> Column:
    """Coerce, truncate, fill with a default (``to_numeric(...).fillna(0).astype(int)``).
    Blank, ``NaN``, infinite and out-of-range values give the default; nothing raises."""
    return F.coalesce(coerce_numeric(c).try_cast(to), F.lit(default).cast(to))


def clean_string(c: str | Column) -> Column:
    """P5: cast to text and strip. A missing value stays NULL (deliberate: the
    reference writes the text 'nan', which then escapes imputation)."""
    return F.trim(col_of(c).cast("string"))


def round_half_even(c: str | Column, digits: int = 2) -> Column:
    """Numpy rounding — scale, round half to even on the binary value, unscale.
    ``F.round`` rounds half up (0.125 -> 0.13); this gives 0.12."""
    scale = float(10 ** digits)
    return F.rint(col_of(c) * scale) / scale


def round_half_up(c: str | Column, digits: int) -> Column:
    """Decimal rounding, half away from zero, on the value's decimal expansion to
    12 places: ties (0.20425 -> 0.2043) come out the same in every engine, unlike
    rounding the scaled binary value."""
    return F.round(col_of(c).cast("decimal(38,12)"), digits).cast("double")


def safe_ratio(num: str | Column, den: str | Column) -> Column:
    """x/0 -> NULL instead of inf or an ANSI error."""
    return F.try_divide(col_of(num), col_of(den))


def flag_above(c: str | Column, threshold) -> Column:
    """P10: 1 if value > threshold else 0; a missing value compares false -> 0."""
    thr = threshold if isinstance(threshold, Column) else F.lit(threshold)
    return F.coalesce(col_of(c) > thr, F.lit(False)).cast("int")


def map_values(c: str | Column, mapping: Mapping, dtype: str | None = None) -> Column:
    """Value map; anything unmapped (or NULL) -> NULL. A small literal map
    (``create_map`` + ``try_element_at``) evaluated inside codegen."""
    if not mapping:
        return F.lit(None).cast(dtype or "string")
    pairs = []
    for k, v in mapping.items():
        pairs += [F.lit(k), F.lit(v)]
    out = F.try_element_at(F.create_map(*pairs), col_of(c))
    return out.cast(dtype) if dtype else out


def map_with_default(c: str | Column, mapping: Mapping, default) -> Column:
    """Value map, unmapped -> default."""
    return F.coalesce(map_values(c, mapping), F.lit(default))


# Fixed values that must equal the reference: risk band edges and messages.
RISK_HIGH = 0.75
RISK_MEDIUM = 0.45
MESSAGES_SINGLE = ("Customer is likely to churn.", "Customer is likely to stay.")
MESSAGES_BATCH = ("Likely to churn.", "Likely to stay.")


def risk_level(p: str | Column) -> Column:
    """>= 0.75 High, >= 0.45 Medium, else Low (on the unrounded probability)."""
    p = col_of(p)
    return F.when(p >= RISK_HIGH, "High").when(p >= RISK_MEDIUM, "Medium").otherwise("Low")


def risk_message(prediction: str | Column, batch: bool = True) -> Column:
    """Message text; the single-row and batch wordings differ."""
    churn, stay = MESSAGES_BATCH if batch else MESSAGES_SINGLE
    return F.when(col_of(prediction) == 1, churn).otherwise(stay)


def title_name(name: str) -> str:
    """P1: '_' -> ' ' then title case (plan-time, on names only)."""
    return name.replace("_", " ").title()


def title_names(df: DataFrame, keep: tuple[str, ...] = ("average_charges", "high_value_customer")) -> DataFrame:
    """Project snake_case columns to the reference's titled names (an output view)."""
    return df.toDF(*[c if c in keep else title_name(c) for c in df.columns])
