"""Column selection, row filters, casts, null filling and outlier rules."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from railtide.constants import (
    FEATURE_SUFFIXES, GEO_FEATURES, LINE_FILTER, PROCESSED_TYPES, REAL_STATUS,
)
from railtide.functions.values import to_number
from railtide.operators.quantiles import as_lookup, exact_quantiles


def drop_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Drop the listed columns; those that do not exist are ignored."""
    return df.drop(*columns)


def filter_in_lists(df: DataFrame, filters: dict = LINE_FILTER, unknown: str = "skip") -> DataFrame:
    """Keep rows whose value is in the list of every filter; a single value counts as a list of one.

    A filter on a column the table does not have is skipped, or raises with ``unknown="raise"``.
    """
    missing = [c for c in filters if c not in df.columns]
    if missing and unknown == "raise":
        raise ValueError(f"filter on unknown columns: {missing}")
    tests = [F.col(c).isin(v if isinstance(v, list) else [v])
             for c, v in filters.items() if c in df.columns]
    return df.where(reduce(lambda a, b: a & b, tests)) if tests else df


def keep_real(df: DataFrame) -> DataFrame:
    """Keep rows measured at both ends, then drop the two status columns."""
    if not {"arr_status", "dep_status"} <= set(df.columns):
        return df
    real = (F.col("arr_status") == REAL_STATUS) & (F.col("dep_status") == REAL_STATUS)
    return df.where(real).drop("arr_status", "dep_status")


def cast_columns(df: DataFrame, types: dict[str, str] = PROCESSED_TYPES) -> DataFrame:
    """Cast the listed columns that exist, keep the others."""
    return df.withColumns({c: F.col(c).cast(t) for c, t in types.items() if c in df.columns})


def coerce_numeric(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: to_number(F.col(c)) for c in columns})


def require_columns(df: DataFrame, required: list[str], optional: list[str] = ()) -> bool:
    """Raise when a required column is missing; tell whether all optional ones are there."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns {missing}, found {df.columns}")
    return all(c in df.columns for c in optional)


def feature_columns(df: DataFrame, extra: list[str] = GEO_FEATURES) -> list[str]:
    return [c for c in df.columns if c.endswith(FEATURE_SUFFIXES) or c in extra]


def select_features(df: DataFrame, extra: list[str] = GEO_FEATURES) -> DataFrame:
    return df.select(*feature_columns(df, extra))


def fill_numeric_zero(df: DataFrame) -> DataFrame:
    """0 for every null in a numeric column."""
    return df.fillna(0, [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)])


def impute(df: DataFrame, median_columns: list[str], zero_columns: list[str]) -> DataFrame:
    """Fill nulls with the column's median or with 0."""
    filled = {c: F.coalesce(F.col(c), F.lit(0)) for c in zero_columns}
    if median_columns:
        df = df.withColumn("_q", as_lookup(exact_quantiles(df, median_columns, [0.5])))
        filled |= {c: F.coalesce(F.col(c), F.col("_q")[c]["q50"]) for c in median_columns}
    return df.withColumns(filled).drop("_q")


def within_sigma(df: DataFrame, column: str, k: float = 3.0) -> DataFrame:
    """Rows at most ``k`` standard deviations from the mean."""
    shape = df.agg(F.struct(F.avg(column).alias("mean"), F.stddev_samp(column).alias("std")).alias("s"))
    near = F.abs(F.col(column) - F.col("_s.mean")) <= k * F.col("_s.std")
    return df.withColumn("_s", shape.scalar()).where(near).drop("_s")


def within_iqr(df: DataFrame, column: str, k: float = 3.0) -> DataFrame:
    """Rows at most ``k`` interquartile ranges outside the quartiles."""
    lookup = as_lookup(exact_quantiles(df, [column], [0.25, 0.75]))
    q = F.col("_q")[column]
    reach = k * (q["q75"] - q["q25"])
    inside = F.col(column).between(q["q25"] - reach, q["q75"] + reach)
    return df.withColumn("_q", lookup).where(inside).drop("_q")


def clip_iqr(df: DataFrame, columns: list[str], k: float = 1.5) -> DataFrame:
    """Pull values to within ``k`` interquartile ranges of the median, then fill nulls with it."""
    lookup = as_lookup(exact_quantiles(df, columns, [0.25, 0.5, 0.75]))

    def clipped(c: str) -> Column:
        q = F.col("_q")[c]
        reach = k * (q["q75"] - q["q25"])
        value = F.col(c)
        held = F.least(F.greatest(value, q["q50"] - reach), q["q50"] + reach)
        return F.when(value.isNotNull(), held).otherwise(q["q50"])

    return df.withColumn("_q", lookup).withColumns({c: clipped(c) for c in columns}).drop("_q")


def robust_scale(df: DataFrame, columns: list[str]) -> DataFrame:
    """``(x - median) / (q75 - q25)``; a column without spread is only centred."""
    lookup = as_lookup(exact_quantiles(df, columns, [0.25, 0.5, 0.75]))

    def scaled(c: str) -> Column:
        q = F.col("_q")[c]
        spread = q["q75"] - q["q25"]
        return (F.col(c) - q["q50"]) / F.when(spread == 0, 1.0).otherwise(spread)

    return df.withColumn("_q", lookup).withColumns({c: scaled(c) for c in columns}).drop("_q")


def narrow_floats(df: DataFrame) -> DataFrame:
    """Every double column as float."""
    return df.withColumns({
        f.name: F.col(f.name).cast("float") for f in df.schema if isinstance(f.dataType, T.DoubleType)})


def union_files(tables: list[DataFrame]) -> DataFrame:
    """Stack tables by column name; a column some of them lack is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
