"""Edge rows of cleaning, encoding, journeys, geography and tracking."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from plain_rows import rows
from railtide.models import features as mf
from railtide.operators import clean, encode, geo, quality, stats, tracking
from railtide.operators.journey import journey_features, weather_interactions
from railtide.sources.files import recent_months


def test_filters_take_scalars_and_skip_or_refuse_unknown_columns(spark):
    df = spark.createDataFrame([("IC2", 1), ("IR1", 2), (None, 3)], "line_text string, i int")
    assert [r["i"] for r in clean.filter_in_lists(df, {"line_text": "IC2", "other": ["x"]}).collect()] == [1]
    with pytest.raises(ValueError):
        clean.filter_in_lists(df, {"other": ["x"]}, unknown="raise")


def test_keep_real_needs_both_ends_and_both_columns(spark):
    df = spark.createDataFrame([("REAL", "REAL", 1), ("REAL", "PROGNOSE", 2), (None, "REAL", 3)],
                               "arr_status string, dep_status string, i int")
    assert rows(clean.keep_real(df)) == [(1,)]
    assert clean.keep_real(df.drop("arr_status")).count() == 3


def test_required_columns(spark):
    df = spark.createDataFrame([(1,)], "a int")
    assert clean.require_columns(df, ["a"], ["b"]) is False
    with pytest.raises(ValueError):
        clean.require_columns(df, ["b"])


def test_codes_are_ranks_in_code_point_order(spark):
    df = spark.createDataFrame([(v,) for v in ["É", "a", None, "Z", "b", "a"]], "station_name string")
    codes = encode.category_codes(df)
    assert {r["value"]: r["code"] for r in codes.collect()} == {"Z": 0, "a": 1, "b": 2, "nan": 3, "É": 4}
    coded = encode.encode_categories(df, codes)
    back = encode.decode_category(coded.drop("station_name"), codes, "station_name", "station_name_encoded", "name")
    assert sorted(r["name"] for r in back.collect()) == sorted(["É", "a", "nan", "Z", "b", "a"])


def test_codes_of_each_column_start_at_zero(spark):
    df = spark.createDataFrame([(str(i % 7), str(i)) for i in range(50)], "a string, b string")
    codes = encode.category_codes(df, ["a", "b", "not_there"])
    found = {c: sorted(r["code"] for r in codes.where(F.col("column") == c).collect()) for c in ("a", "b")}
    assert found == {"a": list(range(7)), "b": list(range(50))}


def stop(journey, minute, key, lat, lon, delay):
    return journey, minute, key, lat, lon, delay


STOP = "journey_id string, dep_minutes int, row_key string, lat double, lon double, dep_delay_s double"
ORDER = ["dep_minutes", "row_key"]


def test_journey_edges(spark):
    df = spark.createDataFrame([
        stop("one", 5, "a", 1.0, 1.0, 9.0),
        stop("tie", 5, "a", 0.0, 0.0, 10.0), stop("tie", 5, "b", 3.0, 4.0, 30.0), stop("tie", 9, "c", 3.0, 4.0, None),
        stop("still", 1, "a", 2.0, 2.0, 1.0), stop("still", 2, "b", 2.0, 2.0, 2.0),
        stop("lost", 1, "a", -999.0, -999.0, 0.0), stop("lost", 2, "b", 0.0, 0.0, 0.0),
    ], STOP)
    for limit in (1, 2, 100):
        got = {(r["journey_id"], r["row_key"]): r for r in journey_features(df, ORDER, max_rows=limit).collect()}
        one = got["one", "a"]
        assert (one["station_sequence"], one["remaining_stops"], one["route_distance"], one["journey_progress"],
                one["prev_station_delay"], one["delay_trend"]) == (0, 0, 0.0, 0.0, 0.0, 0.0)
        a, b, c = (got["tie", k] for k in "abc")
        # The running distance of a stop already holds the leg to the next one.
        assert [a["cumulative_distance"], b["cumulative_distance"], c["cumulative_distance"]] == [5.0, 5.0, 5.0]
        assert [a["journey_progress"], b["journey_progress"]] == [1.0, 1.0]
        assert (b["prev_station_delay"], b["delay_trend"]) == (10.0, 20.0)
        assert (c["prev_station_delay"], c["delay_trend"], c["remaining_stops"]) == (30.0, 0.0, 0)
        assert got["still", "a"]["journey_progress"] == 0.0
        assert got["lost", "a"]["route_distance"] > 1000
        assert journey_features(df, ORDER, sentinel_as_null=True, max_rows=limit).where(
            "journey_id = 'lost' and route_distance > 0").isEmpty()


def test_severe_weather_treats_unknown_as_calm(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, 1.0), (None, 5.0), (9.0, 2.0)], "wind_speed double, total_precipitation double") \
        .withColumns({"temperature_2m": F.lit(3.0), "dewpoint_2m": F.lit(1.0)})
    got = weather_interactions(df)
    assert sorted(r["severe_weather"] for r in got.collect()) == [0, 0, 1, 1]
    assert got.first()["temp_dewpoint_diff"] == 2.0


def test_gazetteer_last_line_wins_and_empty_names_stay_out(spark):
    df = spark.createDataFrame([
        (1, "A", "A", "", 1.0, 1.0, 1), (2, "B", "Be", "A,Bee", 2.0, 2.0, 2), (3, "C", "C", None, 3.0, 3.0, 3)],
        "geonameid long, name string, ascii_name string, alt_names string, latitude double, longitude double, line_no int")
    found = {r["alias"]: r["geonameid"] for r in geo.gazetteer_aliases(df).collect()}
    assert found == {"A": 2, "B": 2, "Be": 2, "Bee": 2, "C": 3}
    stops = spark.createDataFrame([("A",), ("none",), (None,)], "station_name string")
    got = geo.add_coordinates(stops, geo.gazetteer_aliases(df))
    assert rows(got.select("lat", "lon", "geoname_id")) == [(-999.0, -999.0, -1), (-999.0, -999.0, -1), (2.0, 2.0, 2)]


def test_corrections(spark):
    stops = spark.createDataFrame([(1, -999.0, -999.0), (2, 5.0, 5.0)], "station_id int, lat double, lon double")
    empty = spark.createDataFrame([], "encoded_id int, new_latitude double, new_longitude double, status string, line_no int")
    assert rows(geo.apply_corrections(stops, empty)) == rows(stops)
    fixes = spark.createDataFrame([(1, 1.0, 1.0, "updated", 1), (1, 2.0, 3.0, "updated", 2), (9, 0.0, 0.0, "updated", 3),
                                   (2, 7.0, 7.0, "pending", 4)], empty.schema)
    assert rows(geo.apply_corrections(stops, fixes)) == [(1, 2.0, 3.0), (2, 5.0, 5.0)]


def test_tracking_adds_each_new_station_once(spark):
    stops = spark.createDataFrame([(1, -999.0, 0.0), (1, -999.0, 0.0), (2, 1.0, 1.0), (3, 1.0, -999.0)],
                                  "station_id int, lat double, lon double")
    known = spark.createDataFrame([(3, 1.0, 1.0, "2024-01-01", "pending"), (4, None, 1.0, "2024-01-01", "pending"),
                                   (5, 1.0, 1.0, "2024-01-01", "invalid")],
                                  "encoded_id int, new_latitude double, new_longitude double, date_added string, status string")
    missing = tracking.missing_stations(stops)
    got = {r["encoded_id"]: r["status"] for r in tracking.track(known, missing, "2024-02-02").collect()}
    assert got == {1: "pending", 3: "updated", 4: "pending", 5: "invalid"}
    assert tuple(tracking.tracking_summary(known, missing, "2024-02-02").first()) == (4, 1, 2, 1, 1)


def test_recent_months_can_repeat_and_skip():
    assert recent_months(3, date(2024, 3, 31)) == ["2024-03", "2024-01"]
    assert recent_months(1, date(2024, 3, 31)) == ["2024-03"]


def test_histogram_holds_every_delay_and_closes_the_last_bin(spark):
    df = spark.createDataFrame([(-98.0, 98.0), (0.0, None), (98.0, 1.0)], "arr_delay_s double, dep_delay_s double")
    got = stats.delay_histogram(df)
    assert got.agg(F.sum("n")).first()[0] == 5
    assert got.where("measure = 'arr_delay_s' and n > 0").orderBy("bin").select("bin").toPandas()["bin"].tolist() == [0, 24, 48]
    assert got.count() == 2 * 49


def test_histogram_of_zero_delays(spark):
    df = spark.createDataFrame([(0.0, 0.0)], "arr_delay_s double, dep_delay_s double")
    assert stats.delay_histogram(df).agg(F.sum("n")).first()[0] == 2


def test_density_integrates_to_one(spark):
    df = spark.range(500).select((F.randn(1) * 60).alias("x"))
    got = stats.density(df, ["x"]).orderBy("point").toPandas()
    assert len(got) == 200
    assert abs((got["density"].sum() * (got["x"][1] - got["x"][0])) - 1) < 0.01


def test_rolling_mean_is_empty_at_the_edges(spark):
    df = spark.createDataFrame([(h * 60, float(h * 60), None, None) for h in (3, 4, 5, 8)],
                               "arr_minutes int, arr_delay_s double, dep_minutes int, dep_delay_s double")
    got = {r["hour"]: r["trend_min"] for r in stats.hourly_trend(df).collect()}
    assert got == {3: None, 4: 4.0, 5: 17 / 3, 8: None}


def test_metrics_of_perfect_and_mean_predictions(spark):
    df = spark.createDataFrame([(1.0, 1.0, 2.0), (3.0, 3.0, 2.0), (None, 1.0, 1.0)], "y double, p double, m double")
    assert tuple(stats.regression_metrics(df, "y", "p").first()) == (2, 1.0, 0.0)
    assert stats.regression_metrics(df, "y", "m").first()["r2"] == 0.0


def test_coverage_levels(spark):
    df = spark.createDataFrame([(1, 7, True), (1, 8, False), (2, 7, True)],
                               "dep_month int, station_id int, weather_station_found boolean")
    got = {(r["level"], r["month"], r["station_id"]): (r["total"], r["with_weather"], r["coverage_percentage"])
           for r in quality.weather_coverage(df).collect()}
    assert got == {("all", None, None): (3, 2, 200 / 3), ("month", 1, None): (2, 1, 50.0), ("month", 2, None): (1, 1, 100.0),
                   ("station", None, 7): (2, 2, 100.0), ("station", None, 8): (1, 0, 0.0)}


def test_split_does_not_depend_on_partitions(spark):
    df = spark.range(1000).withColumn("key", F.col("id").cast("string"))
    parts = [rows(mf.split_rows(df.repartition(n), ["key"])[1]) for n in (1, 7)]
    assert parts[0] == parts[1] and 120 < len(parts[0]) < 280


def test_sample_is_exact_and_whole_when_small(spark):
    df = spark.range(5000).withColumn("key", F.col("id").cast("string"))
    assert mf.sample_rows(df, ["key"], 700).count() == 700
    assert rows(mf.sample_rows(df.repartition(5), ["key"], 700)) == rows(mf.sample_rows(df, ["key"], 700))
    assert mf.sample_rows(df, ["key"], 9000).count() == 5000


def test_expanding_folds(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1 + i), i) for i in range(11)], "t timestamp_ntz, i int")
    got = {r["i"]: r["fold"] for r in mf.expanding_folds(df, ["t", "i"]).collect()}
    assert got == {0: 0, 1: 0, 2: 0, 3: 0, 4: 0, 5: 1, 6: 1, 7: 2, 8: 2, 9: 3, 10: 3}


def test_clip_fills_nulls_and_keeps_the_rest(spark):
    df = spark.createDataFrame([(v,) for v in [1.0, 2.0, 3.0, 4.0, 1000.0, None]], "x double")
    assert sorted(r["x"] for r in clean.clip_iqr(df, ["x"]).collect()) == [1.0, 2.0, 3.0, 3.0, 4.0, 6.0]
