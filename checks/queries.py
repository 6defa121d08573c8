"""One query per operator, each over whole tables."""

from __future__ import annotations

from datetime import date

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from checks import views as v
from railtide.constants import CATEGORY_COLUMNS, MODEL_WEATHER, WEATHER_MEASURES
from railtide.functions import times, values
from railtide.models import features as mf
from railtide.models import forest
from railtide.operators import (
    asof, clean, encode, geo, journey, quality, stats, tracking,
)
from railtide.plans.train import prepared
from railtide.session import scratch_path, shuffles_freed, store
from railtide.sinks import files as sinks
from railtide.sources import files as sources

AS_OF = date(2001, 8, 15)
QUERIES: dict = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def r6(df: DataFrame, *columns: str) -> DataFrame:
    """Round away the last digits, which depend on the order of a sum."""
    return df.withColumns({c: F.round(F.col(c).cast("double"), 6) for c in columns})


# ---------------------------------------------------------------- sources and sinks

@query
def scan_csv(spark, sf):
    path = scratch_path(spark, "scan_csv")
    with shuffles_freed(spark):
        v.raw_stops(spark, sf).write.option("sep", ";").option("header", True).option("compression", "gzip").csv(path)
    return sources.read_stop_csv(spark, path, exclude=[])


@query
def scan_exclude_columns(spark, sf):
    path = scratch_path(spark, "scan_exclude")
    v.raw_stops(spark, sf).write.option("sep", ";").option("header", True).csv(path)
    return sources.read_stop_csv(spark, path)


@query
def scan_parquet(spark, sf):
    return sources.read_table(spark, sf, "lineitem*.parquet")


@query
def scan_weather(spark, sf):
    path = scratch_path(spark, "scan_weather")
    v.weather(spark, sf).write.option("header", True).option(
        "timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").csv(path)
    return sources.read_weather_csv(spark, path).drop("line_no")


@query
def scan_gazetteer(spark, sf):
    path = scratch_path(spark, "scan_gazetteer")
    v.gazetteer(spark, sf).drop("line_no").write.option("sep", "\t").option("quote", "").csv(path)
    return sources.read_gazetteer(spark, path).drop("line_no")


@query
def tracking_open(spark, sf):
    path = scratch_path(spark, "tracking")
    fresh = sources.open_tracking(spark, path)
    missing = tracking.missing_stations(v.stops(spark, sf))
    stored = scratch_path(spark, "tracking")
    sinks.write_csv(tracking.track(fresh, missing, "2024-12-01"), stored)
    return sources.open_tracking(spark, stored)


@query
def recent_months(spark, sf):
    kept = sources.filter_months(v.stops(spark, sf), sources.recent_months(11, AS_OF), "dep_sched")
    return kept.select("row_key", "dep_sched")


@query
def sink_parquet(spark, sf):
    path = scratch_path(spark, "sink_parquet")
    out = v.stops(spark, sf).select(
        "row_key", "station_name", "lat", "dep_sched", F.date_format(F.to_date("dep_sched"), "yyyy-MM").alias("service_month"))
    sinks.write_table(out, path, ["service_month"])
    return spark.read.parquet(path).withColumn("service_month", F.col("service_month").cast("string"))


@query
def sink_chunked(spark, sf):
    path = scratch_path(spark, "sink_chunked")
    sinks.write_chunks(v.stops(spark, sf).select("row_key", "station_id", "lat", "lon"), path)
    return spark.read.parquet(path)


@query
def sink_csv(spark, sf):
    path = scratch_path(spark, "sink_csv")
    sinks.write_csv(geo.station_mapping(v.stops(spark, sf)), path, ["station_id"], one_file=True)
    return spark.read.option("header", True).schema(
        "station_id int, latitude double, longitude double").csv(path)


@query
def summary_json(spark, sf):
    path = scratch_path(spark, "summary")
    summary = stats.delay_stats(v.timed(spark, sf))
    sinks.write_summary(r6(summary, *summary.columns[1:]), path)
    return spark.read.schema(summary.schema).json(path)


@query
def sink_versioned(spark, sf):
    path = scratch_path(spark, "versions")
    old = v.stops(spark, sf).select("row_key", "station_id", "lat", "lon")
    sinks.write_version(old, path, "20241101_000000")
    fixed = geo.apply_corrections(
        sinks.read_version(spark, path), tracking.refresh_status(v.every_tracking(spark, sf)))
    sinks.write_version(fixed, path, "20241201_000000")
    return sinks.read_version(spark, path)


@query
def encoding_table(spark, sf):
    return encode.encoding_table(encode.category_codes(v.stops(spark, sf)))


# ---------------------------------------------------------------- rows

@query
def drop_columns(spark, sf):
    return clean.drop_columns(v.stops(spark, sf).select("row_key", "line_id", "line_text", "lat"),
                              ["line_text", "not_there"])


@query
def filter_in_list(spark, sf):
    df = clean.filter_in_lists(v.stops(spark, sf), {
        "line_text": ["IC2", "IC3", "IC5", "IC6", "IC8"], "dep_status": "REAL", "not_there": ["x"]})
    return df.select("row_key", "line_text", "dep_status")


@query
def filter_real_status(spark, sf):
    return clean.keep_real(v.stops(spark, sf).select("row_key", "arr_status", "dep_status", "station_id"))


@query
def cast_output(spark, sf):
    df = v.timed(spark, sf).select("row_key", "lat", "arr_delay_s", "dep_minutes", "dep_month", "dep_is_weekend",
                                   F.col("l_orderkey").alias("geoname_id"), F.col("line_id").alias("line_id_encoded"))
    return clean.cast_columns(df)


@query
def coerce_numeric(spark, sf):
    text = F.expr("case when l_linenumber = 2 then 'n/a' else cast(l_orderkey as string) end")
    return clean.coerce_numeric(v.stops(spark, sf).select("row_key", text.alias("x")), ["x"])


@query
def impute_median_zero(spark, sf):
    df = v.weather(spark, sf).select("event_id", "total_precipitation", "snow_cover")
    return clean.impute(df, ["total_precipitation"], ["snow_cover"])


@query
def fill_numeric_zero(spark, sf):
    return clean.fill_numeric_zero(v.weather(spark, sf).select("event_id", "total_precipitation", "snow_cover"))


@query
def select_features(spark, sf):
    return clean.select_features(encode.encode_flags(v.timed(spark, sf)))


@query
def outlier_sigma(spark, sf):
    # The skewed measure has rows beyond three deviations.
    return clean.within_sigma(v.weather(spark, sf).select("event_id", "temperature_2m"), "temperature_2m")


@query
def outlier_iqr(spark, sf):
    return clean.within_iqr(v.weather(spark, sf).select("event_id", "temperature_2m"), "temperature_2m")


@query
def clip_iqr(spark, sf):
    df = clean.clip_iqr(v.weather(spark, sf).select("event_id", *MODEL_WEATHER), MODEL_WEATHER)
    return r6(df, *MODEL_WEATHER)


@query
def cast_float32(spark, sf):
    return clean.narrow_floats(v.weather(spark, sf).select("event_id", "temperature_2m", "wind_speed"))


@query
def union_files(spark, sf):
    df = v.stops(spark, sf)
    return clean.union_files([
        df.select("row_key", "arr_sched"), df.select("row_key", "dep_sched", "station_id")])


# ---------------------------------------------------------------- joins

@query
def geo_enrich(spark, sf):
    df = v.stops(spark, sf).select("row_key", "station_name")
    return r6(geo.add_coordinates(df, geo.gazetteer_aliases(v.gazetteer(spark, sf))), "lat", "lon")


@query
def gazetteer_alias(spark, sf):
    return r6(geo.gazetteer_aliases(v.gazetteer(spark, sf)), "latitude", "longitude")


@query
def asof_nearest(spark, sf):
    df = v.merged(spark, sf).select(
        "row_key", "station_id", "datetime", *WEATHER_MEASURES, "time_diff_minutes", "weather_station_found")
    return r6(df, *WEATHER_MEASURES).withColumn(
        "time_diff_minutes", F.round(F.col("time_diff_minutes").cast("double"), 2))


@query
def asof_duplicates(spark, sf):
    """Altered copies of every observation, some damaged, come later in the file and must not win."""
    first = v.weather(spark, sf).drop("event_id").withColumn("line_no", F.lit(0))
    later = first.withColumns({m: F.when(F.col("station_id") % 2 == 0, F.col(m) - 100) for m in WEATHER_MEASURES})
    both = first.unionByName(later.withColumn("line_no", F.lit(1)))
    df = asof.add_weather(v.timed(spark, sf), both).select(
        "row_key", "station_id", "datetime", *WEATHER_MEASURES, "time_diff_minutes", "weather_station_found")
    return r6(df, *WEATHER_MEASURES).withColumn(
        "time_diff_minutes", F.round(F.col("time_diff_minutes").cast("double"), 2))


@query
def tracking_new(spark, sf):
    missing = tracking.missing_stations(v.stops(spark, sf))
    return tracking.track(v.tracking(spark, sf).drop("line_no"), missing, "2024-12-01")


@query
def apply_corrections(spark, sf):
    fixes = tracking.refresh_status(v.every_tracking(spark, sf))
    return r6(geo.apply_corrections(v.stops(spark, sf).select("row_key", "station_id", "lat", "lon"), fixes),
              "lat", "lon")


@query
def decode_category(spark, sf):
    df = v.stops(spark, sf).select("row_key", "station_name")
    codes = encode.category_codes(df, ["station_name"])
    coded = encode.encode_categories(df, codes, ["station_name"]).drop("station_name")
    return encode.decode_category(coded, codes, "station_name", "station_name_encoded", "station_name")


# ---------------------------------------------------------------- aggregates

def _station_stats(spark, sf):
    return store(stats.station_stats(v.timed(spark, sf)), "stations")


STATION_NUMBERS = ["arr_delay_s_mean", "arr_delay_s_std", "dep_delay_s_mean", "dep_delay_s_std", "bubble_size"]


@query
def station_delay_stats(spark, sf):
    names = v.table(spark, sf, "supplier").selectExpr("cast(s_suppkey as int) as code", "s_name as value",
                                                      "'station' as column")
    named = encode.decode_category(_station_stats(spark, sf), names, "station", "station_id", "station_name")
    return r6(named, *STATION_NUMBERS)


@query
def delay_stats(spark, sf):
    df = stats.delay_stats(v.timed(spark, sf), unit_seconds=60)
    return r6(df, *df.columns[1:])


@query
def delay_by_minute(spark, sf):
    return r6(stats.delay_by_minute(v.timed(spark, sf)), "mean_delay_s")


@query
def delay_by_hour(spark, sf):
    return r6(stats.delay_by_hour(v.timed(spark, sf)), "delay_min")


@query
def delay_by_period(spark, sf):
    return r6(stats.delay_by_period(v.timed(spark, sf)), "delay_min")


@query
def extreme_periods(spark, sf):
    return r6(stats.extreme_periods(v.timed(spark, sf)), "delay_min")


@query
def hourly_trend(spark, sf):
    return r6(stats.hourly_trend(v.timed(spark, sf)), "delay_min", "trend_min")


@query
def weather_coverage(spark, sf):
    return r6(quality.weather_coverage(v.merged(spark, sf)), "coverage_percentage")


@query
def stations_without_weather(spark, sf):
    return quality.stations_without_weather(v.merged(spark, sf))


@query
def weather_time_diff_stats(spark, sf):
    df = quality.time_diff_stats(v.merged(spark, sf))
    return df.select(*[F.round(c, 2).alias(c) for c in df.columns])


@query
def station_mapping(spark, sf):
    return r6(geo.station_mapping(v.stops(spark, sf)), "latitude", "longitude")


@query
def missing_stations(spark, sf):
    return tracking.missing_stations(v.stops(spark, sf))


@query
def tracking_summary(spark, sf):
    missing = tracking.missing_stations(v.stops(spark, sf))
    return tracking.tracking_summary(v.tracking(spark, sf), missing, "2024-12-01")


@query
def tracking_status(spark, sf):
    return tracking.refresh_status(v.every_tracking(spark, sf)).drop("line_no")


@query
def dataset_profile(spark, sf):
    df = encode.encode_flags(v.timed(spark, sf)).select(
        "row_key", "extra_flag_encoded", "cancelled_flag_encoded", "pass_through_flag_encoded",
        F.col("line_id").alias("line_id_encoded"), F.col("station_id").alias("station_name_encoded"))
    path = scratch_path(spark, "profiled")
    sinks.write_table(df, path)
    return quality.written_profile(spark, path)


@query
def geo_describe(spark, sf):
    df = v.stops(spark, sf).select("lat", "lon", F.col("l_orderkey").alias("geoname_id"))
    return r6(quality.describe_columns(df, ["lat", "lon", "geoname_id"]), "mean", "std", "min", "max")


@query
def station_mean_summary(spark, sf):
    return r6(stats.station_mean_summary(_station_stats(spark, sf)), "mean", "std", "median")


@query
def outlier_stations(spark, sf):
    return r6(stats.outlier_stations(_station_stats(spark, sf)), *STATION_NUMBERS)


@query
def top_stations(spark, sf):
    return r6(stats.top_stations(_station_stats(spark, sf)), *STATION_NUMBERS)


@query
def delay_histogram(spark, sf):
    return r6(stats.delay_histogram(v.timed(spark, sf)), "left_edge")


@query
def delay_kde(spark, sf):
    return r6(stats.density(v.timed(spark, sf), stats.DELAYS), "x", "density")


@query
def station_mean_kde(spark, sf):
    return r6(stats.density(_station_stats(spark, sf), ["arr_delay_s_mean", "dep_delay_s_mean"]), "x", "density")


@query
def on_time_rate(spark, sf):
    return r6(stats.on_time_rate(v.timed(spark, sf)), "arrival_pct", "departure_pct")


@query
def rush_hour_box(spark, sf):
    rush = values.is_rush_hour(times.hour_of_minutes(F.col("dep_minutes")))
    return stats.box_numbers(v.timed(spark, sf).withColumn("rush_hour", rush), "rush_hour")


@query
def weather_impact(spark, sf):
    return r6(stats.weather_impact(v.merged(spark, sf)), "slope", "intercept", "correlation")


@query
def delay_category(spark, sf):
    return stats.delay_classes(v.timed(spark, sf))


@query
def regression_metrics(spark, sf):
    df = v.timed(spark, sf).withColumn("p", F.col("dep_delay_s") * 0.5 + F.col("l_partkey") % 100)
    return r6(stats.regression_metrics(df, "dep_delay_s", "p"), "r2", "rmse_min")


# ---------------------------------------------------------------- journeys

def _journey(spark, sf, *columns):
    return r6(journey.journey_features(v.timed(spark, sf), v.ORDER).select("row_key", *columns), *columns)


@query
def journey_distance(spark, sf):
    return _journey(spark, sf, "route_distance", "cumulative_distance")


@query
def journey_progress(spark, sf):
    return _journey(spark, sf, "journey_progress")


@query
def prev_station_delay(spark, sf):
    return _journey(spark, sf, "prev_station_delay")


@query
def delay_trend(spark, sf):
    return _journey(spark, sf, "delay_trend")


@query
def remaining_stops(spark, sf):
    return journey.journey_features(v.timed(spark, sf), v.ORDER).select(
        "row_key", "station_sequence", "remaining_stops")


@query
def historical_pattern(spark, sf):
    df = journey.historical_pattern(v.timed(spark, sf)).select("row_key", "historical_delay_pattern")
    return r6(df, "historical_delay_pattern")


@query
def severe_weather(spark, sf):
    df = journey.weather_interactions(v.weather(spark, sf)).select(
        "event_id", "severe_weather", "temp_dewpoint_diff")
    return r6(df, "temp_dewpoint_diff")


# ---------------------------------------------------------------- scalars

@query
def parse_timestamp(spark, sf):
    kind = F.col("l_linenumber") % 5
    text = F.when(kind == 0, v.day_first("dep_prog", 19)).when(kind == 1, v.day_first("dep_prog", 16)) \
        .when(kind == 2, v.day_first("dep_prog", 10)).when(kind == 3, F.col("dep_prog").cast("string")).otherwise("junk")
    return v.stops(spark, sf).select("row_key", times.parse_timestamp(text).alias("ts"))


@query
def delay_seconds(spark, sf):
    sched, prog = F.col("arr_sched"), F.col("arr_prog")
    return v.stops(spark, sf).select(
        "row_key", times.delay_seconds(sched, prog).alias("delay_s"),
        times.delay_seconds(sched, prog, actual_first=False).alias("opposite_s"))


@query
def time_features(spark, sf):
    names = [f"{p}_{n}" for p in ("arr", "dep") for n in ("minutes", "day_of_week", "month", "is_weekend")]
    return v.timed(spark, sf).select("row_key", *names)


@query
def date_components(spark, sf):
    columns = ["arr_sched", "arr_prog", "dep_sched", "dep_prog"]
    df = times.with_date_components(v.stops(spark, sf).select("row_key", *columns), columns + ["not_there"])
    epoch = F.lit("1970-01-01").cast("timestamp_ntz")
    millis = (times.micros_between(epoch, F.col("dep_prog")) / 1000).cast("bigint")
    return df.withColumn("dep_prog_ms", times.from_epoch_millis(millis)).drop(*columns)


@query
def rush_hour(spark, sf):
    hour = times.hour_of_minutes(F.col("dep_minutes"))
    return v.timed(spark, sf).select(
        "row_key", hour.alias("hour"), values.is_rush_hour(hour).alias("rush_hour"))


@query
def synthetic_datetime(spark, sf):
    return v.timed(spark, sf).select("row_key", "datetime")


@query
def journey_id(spark, sf):
    args = F.col("datetime"), F.col("line_id"), F.col("dep_minutes")
    return v.timed(spark, sf).select(
        "row_key", values.journey_id("date_line", *args).alias("date_line"),
        values.journey_id("date_line_hour", *args).alias("date_line_hour"),
        values.journey_id("trip", F.col("dep_sched"), *args[1:], trip=F.col("l_orderkey")).alias("trip"))


@query
def encode_boolean(spark, sf):
    df = encode.encode_flags(v.stops(spark, sf))
    return df.select("row_key", "extra_flag_encoded", "cancelled_flag_encoded", "pass_through_flag_encoded")


@query
def encode_categorical(spark, sf):
    df = v.stops(spark, sf).select("row_key", *CATEGORY_COLUMNS)
    return encode.encode_categories(df, encode.category_codes(df)).drop(*CATEGORY_COLUMNS)


@query
def encode_all(spark, sf):
    df = v.raw_stops(spark, sf)
    return encode.encode_categories(df, encode.category_codes(df, df.columns), df.columns, replace=True)


# ---------------------------------------------------------------- models

TARGET = "dep_delay_s"


def _model_table(spark, sf, names=mf.COMPACT_FEATURES):
    """``(rows, names)``: the features, both targets and what orders the rows."""
    used = [*names, "row_key", "datetime", "arr_delay_s", TARGET]
    return prepared(v.features(spark, sf, used), names, clip_weather=names is mf.COMPACT_FEATURES)


def _fitted(spark, sf, target=TARGET):
    """A forest of the operator's own settings, the held-out rows and the features."""
    df, names = _model_table(spark, sf)
    train, test = mf.split_rows(df, ["row_key"])
    return forest.train_forest(train, target, names), test, names


def _importances(spark, sf):
    """Importances of the features of two models in many runs by formula, one row per part and model."""
    k = F.create_map(F.lit("arrival"), F.lit(7), F.lit("departure"), F.lit(11))
    named = F.when(F.col("p_partkey") % 25 == 3, "lat").when(F.col("p_partkey") % 25 == 7, "lon").otherwise(
        F.concat("p_brand", F.lit(" "), F.col("p_size")))
    return v.table(spark, sf, "part").withColumn("model", F.explode(F.array(F.lit("arrival"), F.lit("departure")))).select(
        "model", named.alias("feature"),
        ((F.col("p_partkey") * k[F.col("model")]) % 31 / 100).cast("double").alias("importance"))


def _prepared(spark, sf, clip):
    names = [*MODEL_WEATHER, "arr_minutes"]
    df = v.merged(spark, sf).select("row_key", *names, "lat")
    return r6(mf.prepare_features(df, names, clip), *MODEL_WEATHER)


@query
def prepared_full(spark, sf):
    return _prepared(spark, sf, False)


@query
def prepared_compact(spark, sf):
    return _prepared(spark, sf, True)


@query
def feature_vector(spark, sf):
    df, names = _model_table(spark, sf)
    parts = F.array(*[F.col(c).cast("double") for c in names])
    return mf.assembler(names).transform(df).select(
        "row_key", (vector_to_array("features") == parts).alias("in_order"),
        F.size(parts).alias("width"), F.exists(parts, lambda x: x.isNull()).alias("has_null"))


@query
def train_test_split(spark, sf):
    train, test = mf.split_rows(v.stops(spark, sf).select("row_key"), ["row_key"])
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


@query
def sample_rows(spark, sf):
    return mf.sample_rows(v.stops(spark, sf).select("row_key"), ["row_key"], 20_000)


@query
def robust_scale(spark, sf):
    measures = ["temperature_2m", "wind_speed", "total_precipitation", "surface_pressure"]
    df = clean.robust_scale(v.weather(spark, sf).select("event_id", *measures), measures)
    return r6(df, *measures)


@query
def expanding_folds(spark, sf):
    return mf.expanding_folds(v.timed(spark, sf).select("datetime", "row_key"), ["datetime", "row_key"])


@query
def train_forest(spark, sf):
    """Whether all held-out rows were scored and the operator's own forest explains more than their mean does."""
    model, test, _ = _fitted(spark, sf)
    return forest.evaluate(model, test, TARGET).select("n", (F.col("r2") > 0.2).alias("explains"))


@query
def grid_search(spark, sf):
    df, names = _model_table(spark, sf)
    found = forest.grid_search(df, TARGET, names, ["datetime", "row_key"],
                               {"minInstancesPerNode": [5, 10], "minInfoGain": [0.0, 0.1]})
    # One row per grid point.
    before = Window.orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    placed = found.withColumn("place", F.monotonically_increasing_id())
    return placed.select(
        "params", (F.col("mean_r2").isNotNull() & (F.col("std_rmse_min") >= 0)).alias("scored"),
        F.coalesce(F.col("mean_rmse_min") >= F.max("mean_rmse_min").over(before), F.lit(True)).alias("in_order"))


@query
def feature_importance(spark, sf):
    model, _, names = _fitted(spark, sf)
    found = forest.feature_importance(model, names, spark, TARGET)
    return found.agg(
        ((F.count_distinct("feature") == len(names)) & (F.count(F.lit(1)) == len(names))).cast("int").alias("complete"),
        (F.abs(F.sum("importance") - 1) < 1e-9).cast("int").alias("sums_to_one"),
        F.count_if(F.col("importance") < 0).cast("int").alias("negative"))


@query
def importance_mean(spark, sf):
    return r6(forest.importance_mean(_importances(spark, sf)), "importance")


@query
def importance_topk(spark, sf):
    return r6(forest.importance_topk(_importances(spark, sf), 10), "importance")


@query
def geo_importance(spark, sf):
    return r6(forest.geo_importance(_importances(spark, sf)), "geo_pct")


@query
def model_importances(spark, sf):
    """Mean, top and coordinates' importances of the forests of both targets, as facts that hold whatever they look like."""
    df, names = _model_table(spark, sf, mf.FULL_FEATURES)
    train, _ = mf.split_rows(df, ["row_key"])
    found = [forest.feature_importance(forest.train_forest(train, target, names), names, spark, target)
             for target in ("arr_delay_s", "dep_delay_s")]
    both = store(found[0].unionByName(found[1]), "importances")
    mean, top = forest.importance_mean(both), forest.importance_topk(both, 10)
    geo = forest.geo_importance(both).agg(
        F.count(F.lit(1)).alias("models"), F.bool_and(F.col("geo_pct").between(0, 100)).alias("geo_in_range"))
    sums = mean.agg((F.count(F.lit(1)) == len(names)).alias("complete"), (F.abs(F.sum("importance") - 1) < 1e-9).alias("sums_to_one"))
    tops = top.agg(F.count(F.lit(1)).cast("int").alias("top_rows"),
                   (F.sum("importance") * len(names) >= 10 * mean.agg(F.sum("importance")).scalar()).alias("top_above_mean"))
    # One row each.
    return geo.crossJoin(sums).crossJoin(tops)


@query
def permutation_importance(spark, sf):
    model, test, names = _fitted(spark, sf)
    found = forest.permutation_importance(model, test, TARGET, names, ["row_key"])
    finite = F.col("importance").isNotNull() & (F.col("importance_std") >= 0)
    # One row per feature; the previous delay gives most of the departure delay away.
    return found.agg(
        (F.count_distinct("feature") == len(names)).cast("int").alias("complete"),
        (F.count_if(finite) == len(names)).cast("int").alias("finite"),
        (F.max("importance") > 0.01).cast("int").alias("ordered"))


@query
def model_roundtrip(spark, sf):
    model, test, _ = _fitted(spark, sf)
    path = scratch_path(spark, "model")
    forest.save_model(model, path)
    before = forest.evaluate(model, test, TARGET)
    after = forest.evaluate(forest.load_model(path), test, TARGET)
    same = (F.abs(F.col("r2") - F.col("b.r2")) < 1e-9) & (F.abs(F.col("rmse_min") - F.col("b.rmse_min")) < 1e-9)
    return after.withColumn("b", before.agg(F.first(F.struct("r2", "rmse_min"))).scalar()).select(
        "n", same.alias("same_scores"))


@query
def predictions(spark, sf):
    df, names = _model_table(spark, sf)
    train, _ = mf.split_rows(df, ["row_key"])
    model = forest.train_forest(train, TARGET, names)
    reach = df.agg(F.struct(F.min(TARGET).alias("lo"), F.max(TARGET).alias("hi"))).scalar()
    return forest.predict(model, df).select(
        "row_key", TARGET, F.col("prediction").between(reach["lo"], reach["hi"]).alias("predicted"))


@query
def train_classifier(spark, sf):
    """Whether the forest is right more often than the most frequent class would be."""
    df, names = _model_table(spark, sf)
    train, test = mf.split_rows(df, ["row_key"])
    model = forest.train_classifier(train, TARGET, names)
    labelled = test.withColumn("label", forest.class_index(TARGET)).where("label is not null")
    guess = labelled.groupBy("label").count().agg((F.max("count") / F.sum("count"))).scalar()
    return forest.accuracy(model.transform(labelled)).select((F.col("accuracy") > guess).alias("better_than_guessing"))

