"""Feature lists, vectors, splits and scaling."""

from __future__ import annotations

from pyspark.ml.feature import RobustScaler, VectorAssembler
from pyspark.ml import Pipeline
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from railtide.constants import MODEL_WEATHER, TEST_PERCENT
from railtide.operators.clean import clip_iqr, impute
from railtide.operators.ordering import rows_at
from railtide.session import store

# --- Fixed values: feature groups of the merged table -------------------------------------------
BINARY = ["severe_weather", "rush_hour"]
ENGINEERED = ["rush_hour", "severe_weather", "historical_delay_pattern", "prev_station_delay", "delay_trend"]
FULL_FEATURES = (
    ["dep_minutes", "arr_minutes", "hour"]
    + ["lat", "lon", "route_distance", "cumulative_distance", "journey_progress", "remaining_stops"]
    + MODEL_WEATHER + ["temp_dewpoint_diff"]
    + ["extra_flag_encoded", "cancelled_flag_encoded", "pass_through_flag_encoded",
       "line_id_encoded", "line_text_encoded", "station_name_encoded"]
    + ENGINEERED
)
COMPACT_FEATURES = (
    ["hour", "dep_day_of_week", "dep_month", "dep_is_weekend"]
    + ["route_distance", "cumulative_distance", "remaining_stops"]
    + MODEL_WEATHER + ["temp_dewpoint_diff"]
    + ["line_id_encoded", "station_name_encoded"]
    + ENGINEERED
)
# Together these give the departure delay away, except at the first stop of a journey.
LEAKY = ["delay_trend", "prev_station_delay", "historical_delay_pattern"]


def feature_list(df: DataFrame, wanted: list[str] = FULL_FEATURES, exclude_leaky: bool = False) -> list[str]:
    return [c for c in wanted if c in df.columns and not (exclude_leaky and c in LEAKY)]


def prepare_features(df: DataFrame, features: list[str], clip_weather: bool = False) -> DataFrame:
    """No nulls left in the features: weather filled with its median, the rest with 0.

    ``clip_weather`` first pulls weather to within one and a half interquartile ranges of the median.
    """
    weather = [c for c in features if c in MODEL_WEATHER and c in df.columns]
    if weather:
        df = clip_iqr(df, weather) if clip_weather else impute(df, weather, [])
    return df.withColumns({
        c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in features if c not in weather})


def scaled_features(features: list[str]) -> list[str]:
    """The features that are scaled; codes, flags and the previous delay are passed through."""
    return [c for c in features
            if not c.endswith("_encoded") and c not in BINARY and c != "prev_station_delay"]


def vector_order(features: list[str]) -> list[str]:
    """Features in the order of the final vector: scaled ones first."""
    scaled = scaled_features(features)
    return scaled + [c for c in features if c not in scaled]


def assembler(features: list[str], output: str = "features") -> VectorAssembler:
    return VectorAssembler(inputCols=features, outputCol=output, handleInvalid="error")


def preprocessing(features: list[str]) -> Pipeline:
    """Robust scaling of the numeric features into one vector ``features`` with all others."""
    scaled = scaled_features(features)
    passed = [c for c in features if c not in scaled]
    return Pipeline(stages=[
        assembler(scaled, "_numeric"),
        RobustScaler(inputCol="_numeric", outputCol="_scaled", withCentering=True),
        assembler(["_scaled"] + passed),
    ])


def row_hash(keys: list[str]) -> Column:
    """Hexadecimal hash of a row key, the same in any partitioning."""
    return F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys]))


def hash_number(digest: Column) -> Column:
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def split_rows(df: DataFrame, keys: list[str], test_percent: int = TEST_PERCENT):
    """``(train, test)`` by the hash of the row key."""
    is_test = hash_number(row_hash(keys)) % 100 < test_percent
    return df.where(~is_test), df.where(is_test)


def sample_rows(df: DataFrame, keys: list[str], k: int) -> DataFrame:
    """Exactly ``k`` rows (or all, if fewer) with the smallest key hashes, where they are.

    Keys and hashes are stored once. Their rows are counted by the head of the hash, and only those of
    the head that completes ``k`` are ordered, to find the last key that is taken; the sample is then a
    filter, on what was stored if there are no other columns. Rows that repeat that key are taken with it.
    """
    names, named = df.columns, [c for c in df.columns if c in keys]
    hashed = store(df.select(row_hash(keys).alias("_digest"), *named), "hashed")
    digest = F.col("_digest")
    head = F.substring(digest, 1, 4)
    # At most 65,536 rows.
    running = Window.orderBy("head").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    heads = hashed.groupBy(head.alias("head")).agg(F.count(F.lit(1)).alias("n"))
    last = heads.withColumn("_before", F.sum("n").over(running) - F.col("n")).where(
        F.col("_before") < k).orderBy(F.desc("head")).first()
    if last is None:
        return df.limit(0)
    place = F.struct(digest.alias("digest"), *keys)
    edge = hashed.where(head == last["head"]).select(place.alias("place")).orderBy("place").limit(k - last["_before"])
    end = edge.agg(F.max("place").alias("place")).scalar()
    known = hashed if set(names) == set(named) else df.withColumn("_digest", row_hash(keys))
    return known.where((head < last["head"]) | ((head == last["head"]) & (place <= end))).select(*names)


def fold_bounds(df: DataFrame, order: list[str], folds: int = 3) -> DataFrame:
    """``(fold, start)``: the first row, as a struct of ``order``, of each of the last ``folds`` blocks.

    With ``t = rows div (folds + 1)``, the last ``folds * t`` rows in time order form blocks of ``t``.
    """
    # Stored, so that counting and cutting the order do not compute the table again.
    keys = store(df.select(*order), "order")
    total = keys.count()
    size = total // (folds + 1)
    start_of = {total - size * (folds + 1 - f): f for f in range(1, folds + 1)}
    fold = F.element_at(F.create_map(*[F.lit(v) for kv in start_of.items() for v in kv]), F.col("pos"))
    return rows_at(keys, order, list(start_of)).select(
        fold.cast("int").alias("fold"), F.struct(*order).alias("start"))


def expanding_folds(df: DataFrame, order: list[str], folds: int = 3) -> DataFrame:
    """Add ``fold``: 0 for the rows that are only ever trained on, then 1 to ``folds`` in time order."""
    # One row per fold.
    starts = fold_bounds(df, order, folds).agg(F.collect_list("start")).scalar()
    position = F.struct(*order)
    return df.withColumn("_starts", starts).withColumn(
        "fold", F.size(F.filter("_starts", lambda s: s <= position)).cast("int")).drop("_starts")
