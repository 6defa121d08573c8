"""What jobs leave on disk while they run: shuffle files, texts and dumps that nothing needs any more."""

import glob
import os
import time

import pytest
from pyspark.sql import functions as F

from plain_rows import SMALL, rows
from checks import queries, views
from railtide.models import features as mf
from railtide.operators import encode
from railtide.session import forget, store


def shuffle_files(spark) -> set[str]:
    folders = list(spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString())
    return {f for d in folders for f in glob.glob(f"{d}/*/shuffle_*")}


def left_after(spark, before: set[str]) -> set[str]:
    """Files that came since ``before``, given some time to go."""
    for _ in range(50):
        left = shuffle_files(spark) - before
        if not left:
            break
        time.sleep(0.1)
    return left


def test_stored_tables_leave_no_shuffle_files(spark):
    before = shuffle_files(spark)
    found = store(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count())
    assert left_after(spark, before) == set()
    assert rows(found, "k")[0] == (0, 143) and found.count() == 7
    # The setting is as it was, also after a query that fails.
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(name, None)
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        store(spark.range(3).select((F.lit(1) / (F.col("id") - 1)).alias("x")))
    assert spark.conf.get(name, None) == was
    forget(found)
    assert not glob.glob(f"{found.inputFiles()[0].removeprefix('file:')}")


def coded_rows():
    return [(f"trip {i % 97}", f"{i % 11}", None if i % 5 == 0 else f"t{i % 31}", i) for i in range(400)]


@pytest.mark.parametrize("limit", [0, 12, 1000])
def test_codes_in_place_of_texts(spark, limit):
    df = spark.createDataFrame(coded_rows(), "trip string, line string, text string, i int").repartition(5)
    columns = ["trip", "line", "text"]
    codes = encode.category_codes(df, columns)
    plain = encode.encode_categories(df, codes, columns, max_broadcast_rows=limit).drop(*columns)
    placed = encode.encode_categories(df, codes, columns, max_broadcast_rows=limit, replace=True)
    assert placed.columns == plain.columns == ["i", "trip_encoded", "line_encoded", "text_encoded"]
    assert rows(placed) == rows(plain) and placed.count() == 400


def test_codes_leave_no_shuffle_files_and_texts_go_before_the_next_join(spark):
    df = spark.createDataFrame(coded_rows(), "trip string, line string, text string, i int")
    before = shuffle_files(spark)
    codes = encode.category_codes(df, ["trip", "line", "text"])
    assert left_after(spark, before) == set()
    placed = encode.encode_categories(df, codes, ["trip", "line", "text"], max_broadcast_rows=0, replace=True)
    # Only the last lookup is still to be made, over rows that hold no other text.
    plan = placed._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftOuter") == 1
    assert "trip#" not in plan and "line#" not in plan


def test_dump_is_packed_and_leaves_no_shuffle_files(spark):
    before = shuffle_files(spark)
    found = queries.QUERIES["scan_csv"](spark, SMALL)
    assert left_after(spark, before) == set()
    text = found.select(F.sum(sum(F.coalesce(F.length(c), F.lit(0)) + 1 for c in found.columns))).scalar()
    dump = sum(os.path.getsize(f.removeprefix("file:").removeprefix("//")) for f in found.inputFiles())
    assert dump * 2 < found.agg(text.alias("n")).first()["n"]
    assert rows(found) == rows(views.raw_stops(spark, SMALL))


def test_features_store_only_what_they_are_made_from(spark, monkeypatch):
    stored = []
    monkeypatch.setattr(views, "store", lambda df, name: stored.append(set(df.columns)) or store(df, name))
    _, names = queries._model_table(spark, SMALL)
    assert set(mf.COMPACT_FEATURES) == set(names)
    assert len(stored) == 1 and not stored[0] & {"station_name", "line_text", "arr_prog", "dep_prog", "journey_id", "l_orderkey"}
    wanted = ["row_key", "datetime", "hour", "remaining_stops", "historical_delay_pattern", "severe_weather", "dep_delay_s"]
    some, every = views.features(spark, SMALL, wanted), views.features(spark, SMALL)
    assert sorted(some.columns) == sorted(wanted)
    exact = [c for c in wanted if c != "historical_delay_pattern"] + [F.round("historical_delay_pattern", 6)]
    assert rows(some.select(*exact)) == rows(every.select(*exact))
