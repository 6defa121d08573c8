"""Shape of physical plans, and the whole chain from dumps to models."""

import os
import re
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from checks import queries, views
from plain_rows import SMALL, rows
from railtide.constants import PROCESSED_HEADERS, PROCESSED_TYPES
from railtide.models import forest
from railtide.operators import clean, encode, geo, quality, stats
from railtide.operators.journey import journey_features
from railtide.plans import analyse, ingest, maintain, train, weather
from railtide.session import leaves_nothing, scratch_path, store
from railtide.sinks import files as sinks
from railtide.sources.files import read_processed, read_weather_csv


def plan(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


@pytest.mark.parametrize("name", ["asof_nearest", "journey_distance", "delay_kde", "weather_coverage",
                                  "historical_pattern", "encode_categorical", "clip_iqr"])
def test_no_python_and_no_cross_joins(spark, name):
    text = plan(queries.QUERIES[name](spark, SMALL))
    for node in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in text


def test_filters_and_columns_reach_the_scan(spark):
    df = clean.filter_in_lists(views.table(spark, SMALL, "lineitem"), {"l_returnflag": "R"}).select("l_orderkey")
    text = plan(df)
    assert "PushedFilters: [IsNotNull(l_returnflag), EqualTo(l_returnflag,R)]" in text
    assert "ReadSchema: struct<l_orderkey:bigint,l_returnflag:string>" in text


def test_small_lookup_is_broadcast_and_events_are_not_shuffled(spark):
    events = spark.read.parquet(f"{SMALL}/lineitem.parquet").select(
        F.col("l_suppkey").cast("string").alias("station_name"))
    aliases = geo.gazetteer_aliases(views.gazetteer(spark, SMALL))
    text = plan(geo.add_coordinates(events, aliases))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_journeys_of_normal_length_take_one_shuffle(spark):
    stored = views.timed(spark, SMALL).limit(10_000)
    path = tempfile.mkdtemp(prefix="run-", dir="/tmp") + "/t"
    stored.write.parquet(path)
    text = plan(journey_features(spark.read.parquet(path), views.ORDER))
    assert text.split("\n\n")[0].count("Exchange") == 1


def test_whole_chain(spark):
    root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    views.raw_stops(spark, SMALL).write.option("sep", ";").option("header", True).csv(f"{root}/raw")
    views.gazetteer(spark, SMALL).drop("line_no").coalesce(1).write.option("sep", "\t").option("quote", "").csv(f"{root}/gaz")

    filters = {"line_text": [f"IC{i}" for i in range(10)]}
    counts = ingest.run(spark, f"{root}/raw", f"{root}/out", f"{root}/gaz", filters)
    processed = spark.read.parquet(f"{root}/out/processed")
    expected = clean.keep_real(clean.filter_in_lists(views.stops(spark, SMALL), filters)).count()
    assert counts == {"cleaned": expected, "written": expected}
    assert processed.count() == expected
    files, described = sinks.read_back(spark, f"{root}/out/processed", ["lat", "lon", "geoname_id"])
    assert files.first()["files"] > 0 and described.first()["rows"] == expected
    assert {f.name: f.dataType.simpleString() for f in processed.schema if f.name in PROCESSED_TYPES} == PROCESSED_TYPES
    codes = sinks.read_encodings(spark, f"{root}/out/encodings")
    assert codes.where("column = 'extra_flag'").count() == 4
    assert os.listdir(f"{root}/out/encodings/text")

    ingest.run(spark, f"{root}/raw", f"{root}/same", f"{root}/gaz", filters, source_layout=True)
    assert set(spark.read.parquet(f"{root}/same/processed").columns) == set(PROCESSED_HEADERS.values())

    analyse.run(spark, f"{root}/out/processed", f"{root}/out/encodings", f"{root}/stats")
    stations = spark.read.option("header", True).csv(f"{root}/stats/station_stats")
    assert stations.count() == processed.select("station_name_encoded").distinct().count()
    assert stations.where("station_name is null").isEmpty()
    assert spark.read.json(f"{root}/stats/delay_stats").count() == 2

    views.weather(spark, SMALL).drop("event_id").write.option("header", True).csv(f"{root}/weather")
    weather.run(spark, f"{root}/out/processed", f"{root}/weather", f"{root}/joined", mode="synthetic")
    merged = spark.read.parquet(f"{root}/joined/merged")
    assert merged.count() == expected
    assert spark.read.parquet(f"{root}/joined/coverage/levels").where("level = 'all'").first()["total"] == expected

    small = {"numTrees": 3, "maxDepth": 4}
    train.run(spark, f"{root}/joined/merged", f"{root}/full", ["dep_minutes", "trip_id"], ["trip_id"], **small)
    assert spark.read.json(f"{root}/full/departure_summary").first()["r2"] > 0.2
    train.run(spark, f"{root}/joined/merged", f"{root}/compact", ["dep_minutes", "trip_id"], ["trip_id"], "compact",
              {"minInstancesPerNode": [5, 10]}, **small)
    assert spark.read.json(f"{root}/compact/arrival_cv").count() == 2
    assert forest.load_model(f"{root}/compact/arrival_model").stages
    assert spark.read.parquet(f"{root}/compact/arrival_predictions").count() == merged.count()
    train.run_on_processed(spark, f"{root}/out/processed", f"{root}/plain", ["trip_id"], **small)
    assert spark.read.parquet(f"{root}/plain/departure_predictions").count() == processed.count()
    train.run_classifier(spark, f"{root}/out/processed", f"{root}/classes", ["trip_id"], num_trees=3, maxDepth=4)
    assert 0 < spark.read.json(f"{root}/classes/class_accuracy").first()[0] <= 1
    same = read_processed(spark, f"{root}/same/processed")
    assert set(same.columns) == set(PROCESSED_HEADERS)
    analyse.run(spark, f"{root}/same/processed", f"{root}/same/encodings", f"{root}/same/stats")
    for name in ("histogram", "delay_stats", "on_time", "classes", "hourly"):
        assert spark.read.json(f"{root}/same/stats/{name}").count() == spark.read.json(f"{root}/stats/{name}").count()
    month = processed.agg(F.max("period")).first()[0]
    text = plan(read_processed(spark, f"{root}/out/processed", [month]).select("trip_id"))
    assert "PartitionFilters: [" in text and month in text.split("PartitionFilters: [")[1].split("\n")[0]
    assert spark.read.json(f"{root}/joined/coverage/report/levels").where("level = 'all'").first()["total"] == expected
    assert spark.read.json(f"{root}/plain/geo_importance").count() == 2


def test_maintenance(spark):
    root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    stops = views.stops(spark, SMALL).select("row_key", F.col("station_id").alias("station_name_encoded"), "lat", "lon")
    sinks.write_version(stops, f"{root}/table", "20240101")
    first = maintain.detect_missing(spark, stops, f"{root}/none", f"{root}/list", "2024-01-02").first()
    lost = stops.where("lat = -999").select("station_name_encoded").distinct().count()
    assert tuple(first) == (lost, lost, lost, 0, 0)
    assert maintain.apply_updates(spark, f"{root}/table", f"{root}/list", "20240103") is False

    fixed = spark.read.option("header", True).csv(f"{root}/list").withColumns(
        {"new_latitude": F.lit(46.0), "new_longitude": F.lit(7.0)})
    fixed.write.option("header", True).csv(f"{root}/edited")
    second = maintain.detect_missing(spark, stops, f"{root}/edited", f"{root}/list2", "2024-01-04").first()
    assert tuple(second) == (lost, 0, 0, lost, 0)
    assert maintain.apply_updates(spark, f"{root}/table", f"{root}/list2", "20240105")
    now = sinks.read_version(spark, f"{root}/table")
    assert now.count() == stops.count() and now.where("lat = -999").isEmpty()
    assert rows(sinks.read_version(spark, f"{root}/table", "20240101").select("row_key", "lat")) == rows(stops.select("row_key", "lat"))
    maintain.write_station_mapping(now, f"{root}/mapping")
    assert spark.read.option("header", True).csv(f"{root}/mapping").columns == ["station_id", "latitude", "longitude"]


def test_chunks_have_fixed_size(spark):
    root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    sinks.write_chunks(spark.range(0, 25_000, 1, 1), f"{root}/chunks")
    import pyarrow.parquet as pq
    found = [pq.ParquetFile(f"{root}/chunks/{f}").metadata for f in sorted(os.listdir(f"{root}/chunks")) if f.endswith(".parquet")]
    assert sorted(m.num_rows for m in found) == [5_000, 10_000, 10_000]
    assert all(m.row_group(i).num_rows <= 1_000 for m in found for i in range(m.num_row_groups))


def test_csv_with_another_header_fails(spark):
    root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    from railtide.sources.files import read_stop_csv
    raw = views.raw_stops(spark, SMALL)
    raw.select(*reversed(raw.columns)).write.option("sep", ";").option("header", True).csv(f"{root}/raw")
    with pytest.raises(Exception, match="header"):
        read_stop_csv(spark, f"{root}/raw", exclude=[]).collect()
    assert set(read_stop_csv(spark, f"{root}/raw", fixed_header=False).columns) >= {"line_text", "dep_sched"}


def test_importance_of_a_column_that_decides(spark):
    df = spark.range(2000).select(
        F.col("id").cast("string").alias("key"), (F.col("id") % 50).cast("double").alias("a"),
        (F.col("id") % 7).cast("double").alias("b")).withColumn("y", F.col("a") * 10)
    model = forest.train_forest(df, "y", ["a", "b"], scale=False, numTrees=5, maxDepth=6)
    again = forest.train_forest(df, "y", ["a", "b"], scale=False, numTrees=5, maxDepth=6)
    assert forest.evaluate(model, df, "y").first() == forest.evaluate(again, df, "y").first()
    assert forest.feature_importance(model, ["a", "b"], spark).first()["feature"] == "a"
    top = forest.permutation_importance(model, df, "y", ["a", "b"], ["key"]).first()
    assert top["feature"] == "a" and top["importance"] > 0.5


def test_encoder_plan_grows_with_the_columns(spark):
    """Every large column adds one join; the facts appear once however many there are."""
    df = spark.range(2000).select(
        "id", *[(F.col("id") % (60 + n)).cast("string").alias(f"c{n}") for n in range(5)],
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("c5"))
    root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    df.write.parquet(f"{root}/facts")
    facts = spark.read.parquet(f"{root}/facts")
    columns = [f"c{n}" for n in range(6)]
    codes = encode.category_codes(facts, columns)
    plain = encode.encode_categories(facts, codes, columns)
    large = encode.encode_categories(facts, codes, columns, max_broadcast_rows=50, max_rows=100)
    names = ["id", *[f"{c}_encoded" for c in columns]]
    assert rows(plain.select(names)) == rows(large.select(names))
    optimised = large._jdf.queryExecution().optimizedPlan().toString()
    assert optimised.count("Relation [id#") == 1


def test_station_maximum_takes_no_single_task(spark):
    text = plan(stats.station_stats(views.timed(spark, SMALL)))
    assert "SinglePartition" not in text.split("Subqueries")[0]


def test_analyse_reads_the_table_a_few_times(spark):
    root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    df = views.timed(spark, SMALL)
    counts = store(stats.delay_counts(df), "counts")
    by_minute = store(stats.delay_by_minute(df), "by-minute")
    pairs = [
        (stats.delay_stats(df), stats.delay_stats(None, counts=counts)),
        (stats.delay_histogram(df), stats.delay_histogram(None, counts=counts)),
        (stats.delay_classes(df), stats.delay_classes(None, counts=counts)),
        (stats.delay_by_period(df), stats.delay_by_period(None, by_minute)),
        (stats.on_time_rate(df), stats.on_time_rate(None, counts=counts)),
    ]
    for plain, derived in pairs:
        a, b = (x.toPandas().sort_values(x.columns[:2], ignore_index=True).round(6) for x in (plain, derived))
        assert a.equals(b[a.columns])
        assert "lineitem" not in plan(derived)
    near = stats.delay_stats(df, accuracy=10_000).toPandas()
    assert (near.set_index("measure")["median"] - pairs[0][0].toPandas().set_index("measure")["median"]).abs().max() <= 5
    assert os.path.isdir(root)


def test_a_plan_leaves_nothing_behind(spark):
    seen = []

    @leaves_nothing
    def some_plan(session):
        seen.append(scratch_path(session, "x").rsplit("/", 1)[0])
        return store(session.range(5), "y").count()

    assert some_plan(spark) == 5
    assert seen[0].startswith("/") and not os.path.exists(seen[0])


def test_weather_with_another_column_order_fails(spark):
    root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    df = views.weather(spark, SMALL).drop("event_id").coalesce(1)
    df.write.option("header", True).csv(f"{root}/w")
    df.select(*reversed(df.columns)).write.mode("append").option("header", True).csv(f"{root}/w")
    with pytest.raises(Exception, match="header"):
        read_weather_csv(spark, f"{root}/w").collect()


def test_full_variant_keeps_extreme_weather(spark):
    df = spark.createDataFrame([(1.0,)] * 20 + [(500.0,), (None,)], "wind_speed double")
    from railtide.models import features as mf
    full = sorted(r[0] for r in mf.prepare_features(df, ["wind_speed"]).collect())
    assert full[-1] == 500.0 and full[0] == 1.0 and len(full) == 22
    assert max(r[0] for r in mf.prepare_features(df, ["wind_speed"], clip_weather=True).collect()) == 1.0


def test_sample_is_spread_out_and_scores_are_of_all_rows(spark):
    from railtide.models import features as mf
    df = spark.range(0, 150_000, 1, 8).select(F.col("id").cast("string").alias("key"), (F.col("id") % 50).cast("double").alias("a")) \
        .withColumn("y", F.col("a") * 10)
    taken = mf.sample_rows(df, ["key"], 30_000)
    assert taken.count() == 30_000 and taken.rdd.getNumPartitions() > 1
    part, test = mf.split_rows(df, ["key"])
    model = forest.train_forest(mf.sample_rows(part, ["key"], 1_000), "y", ["a"], scale=False, numTrees=2, maxDepth=4)
    assert forest.summary(model, test, "m", "y", ["a"], {}).first()["n"] == test.count() > 29_000


def test_unfinished_versions_are_not_read(spark):
    root = tempfile.mkdtemp(prefix="run-", dir="/tmp") + "/table"
    with pytest.raises(FileNotFoundError, match="no committed version"):
        sinks.read_version(spark, root)
    sinks.write_version(spark.range(3), root, "20240101")
    # A run that died: data without a marker, newer than the rest.
    spark.range(1).write.parquet(f"{root}/version=20240301")
    assert sinks.versions(spark, root) == ["20240101"] and sinks.read_version(spark, root).count() == 3
    with pytest.raises(FileNotFoundError, match="20240301"):
        sinks.read_version(spark, root, "20240301")
    sinks.write_version(spark.range(7), root, "20240301")
    assert sinks.versions(spark, root) == ["20240101", "20240301"] and sinks.read_version(spark, root).count() == 7
    with pytest.raises(FileExistsError):
        sinks.write_version(spark.range(1), root, "20240101")
    assert sinks.read_version(spark, root, "20240101").count() == 3


def test_profile_from_footers(spark):
    path = tempfile.mkdtemp(prefix="run-", dir="/tmp") + "/table"
    df = spark.range(0, 5000, 1, 4).select(
        F.when(F.col("id") % 7 != 0, F.col("id") % 50 - 3).cast("int").alias("a_encoded"), (F.col("id") % 2).alias("b_encoded"), F.col("id").cast("string").alias("name"))
    df.write.parquet(path)
    key = lambda table: rows(table.select("column", "total_rows", "unique_values", "min_code", "max_code", "columns"))
    assert key(quality.written_profile(spark, path)) == key(quality.dataset_profile(df))
    footers = quality.footer_table(spark, path, ["a_encoded"])
    text = footers._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PushedAggregation: \[[^\]]*COUNT\(\*\)", text)
    assert tuple(footers.first()) == (5000, df.where("a_encoded is not null").count(), -3, 46)
    files = quality.table_files(spark, path).first()
    import glob
    parts = glob.glob(f"{path}/*.parquet")
    assert tuple(files) == (len(parts), sum(map(os.path.getsize, parts)))


def test_kernels_visit_only_points_in_reach(spark):
    df = spark.createDataFrame([(float(x),) for x in [*range(2000), *[10.0] * 50, 90_000.0]], "x double")
    counts = stats.known_counts(df, ["x"], None)
    shape = spark.createDataFrame([("x", 1.5, 0.0, 90_000.0)], "measure string, _h double, _lo double, _hi double")
    visits = stats.visited_points(counts, shape, 20_000)
    step = (90_000 + 9) / 19_999
    assert visits.count() <= 2001 * (2 * stats.KERNEL_REACH * 1.5 / step + 1)
    far = visits.where(F.abs(F.col("_x") - F.col("value")) > stats.KERNEL_REACH * 1.5 + 1e-6)
    assert far.isEmpty()
    whole = stats.density(df, ["x"], unit=1).orderBy("point").collect()
    values = np.array([r["x"] for r in df.collect()])
    h = values.std(ddof=1) * len(values) ** -0.2
    for r in whole[::17]:
        want = np.exp(-0.5 * ((r["x"] - values) / h) ** 2).sum() / (len(values) * h * np.sqrt(2 * np.pi))
        assert abs(r["density"] - want) <= 1e-12 * max(1e-3, want) + 1e-18
    assert len(whole) == stats.GRID_POINTS


def test_sample_reads_its_table_at_most_twice(spark):
    from railtide.models import features as mf
    path = tempfile.mkdtemp(prefix="run-", dir="/tmp") + "/table"
    spark.range(0, 9000, 1, 3).select(F.col("id").cast("string").alias("key"), "id").write.parquet(path)
    table = spark.read.parquet(path)
    whole, keys = mf.sample_rows(table, ["key"], 1234), mf.sample_rows(table.select("key"), ["key"], 1234)
    assert whole.count() == keys.count() == 1234 and rows(whole.select("key")) == rows(keys)
    assert plan(keys).count(path) == 0 and plan(whole).count(path) == 1
