"""Hot groups, large lookups and exact quantiles give the same rows as the plain way."""

import random
import re
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from plain_rows import SMALL, rows
from checks import views
from railtide.operators import ordering, quantiles, skew, stats
from railtide.operators.asof import add_weather
from railtide.operators.journey import FEATURES, historical_pattern, journey_features


@pytest.fixture(scope="module")
def timed(spark):
    """A third of all stops belong to one journey."""
    df = views.timed(spark, SMALL)
    hot = F.pmod(F.xxhash64("row_key"), F.lit(3)) == 0
    return df.withColumn("journey_id", F.when(hot, "hot").otherwise(F.col("journey_id"))).cache()


def test_long_journeys_are_split_without_changing_them(spark, timed):
    plain = journey_features(timed, views.ORDER).select("row_key", *FEATURES)
    split = journey_features(timed, views.ORDER, max_rows=40).select("row_key", *FEATURES)
    a, b = (df.toPandas().sort_values("row_key", ignore_index=True) for df in (plain, split))
    assert len(a) == len(b) == timed.count()
    for c in FEATURES:
        np.testing.assert_allclose(a[c].astype(float), b[c].astype(float), rtol=1e-9, atol=1e-9, err_msg=c)


def test_split_journey_of_identical_minutes(spark, timed):
    one_minute = timed.withColumn("dep_minutes", F.lit(5))
    plain = journey_features(one_minute, views.ORDER).select("row_key", "station_sequence", "prev_station_delay")
    split = journey_features(one_minute, views.ORDER, max_rows=100).select(
        "row_key", "station_sequence", "prev_station_delay")
    assert rows(plain) == rows(split)


def test_historical_pattern_with_hot_group(spark, timed):
    one = timed.withColumn("line_id", F.when(F.col("journey_id") == "hot", 1).otherwise(F.col("line_id"))) \
        .withColumn("station_id", F.when(F.col("journey_id") == "hot", 1).otherwise(F.col("station_id")))
    pick = lambda df: df.select("row_key", F.round("historical_delay_pattern", 6))
    assert rows(pick(historical_pattern(one))) == rows(pick(historical_pattern(one, max_rows=5)))


def test_join_lookup_by_shuffle_equals_broadcast(spark):
    facts = spark.range(0, 3000, 1, 6).select(
        "id", F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 10 == 1, None).otherwise(F.col("id") % 50).alias("k"))
    lookup = spark.range(40).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    small = skew.join_lookup(facts, lookup, ["k"])
    large = skew.join_lookup(facts, lookup, ["k"], max_broadcast_rows=5, max_rows=100)
    assert "_salt" not in large.columns
    assert rows(small.select("id", "k", "v")) == rows(large.select("id", "k", "v"))
    assert large.count() == 3000


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_only_rows_of_hot_keys_are_dealt_out(spark):
    facts = spark.range(0, 3000, 1, 6).select(
        "id", F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 10 == 1, None).otherwise(F.col("id") % 50).alias("k"))
    lookup = spark.createDataFrame([(i, i * 2) for i in range(60)], "k long, v long")
    hashed = skew.key_hash(["k"], facts.schema)
    hot = skew.frequent_hashes(facts, hashed, 300)
    want = {r["h"]: r["n"] for r in facts.groupBy(hashed.alias("h")).agg(F.count("*").alias("n")).where("n > 300").collect()}
    assert hot == want and len(hot) == 1
    cold = plan_of(skew.join_spread(facts, lookup, ["k"], {}))
    assert "xxhash64" not in cold and "_salt" not in cold
    spread = skew.join_spread(facts, lookup, ["k"], hot, 300)
    salts = re.findall(r"CASE WHEN (.*?) END AS _salt", plan_of(spread))
    assert len(salts) == 1 and re.match(r"\(_copies#\d+ > 1\) THEN .*ELSE 0", salts[0])
    # Every other hash is one of the key alone.
    hashed_by = re.findall(r"xxhash64\(([^)]*?), 42\) AS _hash", plan_of(spread))
    assert len(hashed_by) == 2 and not any("," in x or "id#" in x for x in hashed_by)
    plain = facts.join(lookup, "k", "left")
    assert rows(spread.select("id", "k", "v")) == rows(plain.select("id", "k", "v"))


def test_sketch_counts_many_keys_at_once(spark):
    df = spark.range(0, 400_000, 1, 8).select(F.when(F.col("id") % 4 == 0, "a").when(F.col("id") % 5 == 1, "b").otherwise(
        F.col("id").cast("string")).alias("k"), F.lit(1.5).alias("x"))
    name = lambda k: df.select(skew.key_hash(["k"], df.schema).alias("h")).where(F.col("h") == F.xxhash64(F.lit(k))).first()["h"]
    hot = skew.frequent_hashes(df, skew.key_hash(["k"], df.schema), 50_000)
    assert set(hot) == {name("a"), name("b")}
    assert 100_000 <= hot[name("a")] <= 100_100 and 60_000 <= hot[name("b")] <= 80_100


def test_hot_key_of_another_type_and_minus_zero(spark):
    facts = spark.range(0, 900, 1, 3).select("id", F.when(F.col("id") % 2 == 0, 0.0).otherwise(-0.0).alias("k"))
    lookup = spark.createDataFrame([(0.0, "zero")], "k float, v string")
    got = skew.join_lookup(facts, lookup, ["k"], max_broadcast_rows=0, max_rows=50)
    assert got.where("v = 'zero'").count() == 900
    whole = spark.range(0, 900, 1, 3).select("id", F.lit(5).cast("int").alias("k"))
    large = spark.createDataFrame([(5, "five")], "k long, v string")
    assert skew.join_lookup(whole, large, ["k"], max_broadcast_rows=0, max_rows=50).where("v = 'five'").count() == 900


def test_hot_key_without_lookup_row_stays(spark):
    facts = spark.range(0, 500, 1, 4).select("id", F.lit("absent").alias("k"))
    lookup = spark.createDataFrame([("x", 1)], "k string, v int")
    got = skew.join_lookup(facts, lookup, ["k"], max_broadcast_rows=0, max_rows=50)
    assert got.count() == 500 and got.where("v is not null").isEmpty()


def test_ordered_index_counts_up_from_zero(spark):
    df = spark.range(1000).select(F.md5(F.col("id").cast("string")).alias("h"))
    got = ordering.ordered_index(df, ["h"]).orderBy("pos").collect()
    assert [r["pos"] for r in got] == list(range(1000))
    assert [r["h"] for r in got] == sorted(r["h"] for r in got)


@pytest.mark.parametrize("seed", range(3))
def test_quantiles_equal_numpy(spark, seed):
    rng = random.Random(seed)
    data = [rng.choice([None, 0.0, rng.gauss(0, 1e6), float(rng.randint(-5, 5)), rng.random()]) for _ in range(rng.randint(1, 700))] + [1.0]
    df = spark.createDataFrame([(v, "a" if i % 3 else "b") for i, v in enumerate(data)], "x double, g string")
    probabilities = [0.0, 0.1, 0.25, 0.5, 0.755, 1.0]
    for r in quantiles.exact_quantiles(df, ["x"], probabilities, ["g"]).collect():
        own = [v for i, v in enumerate(data) if v is not None and ("a" if i % 3 else "b") == r["g"]]
        assert r["n"] == len(own)
        want = np.quantile(own, probabilities)
        np.testing.assert_allclose([r[quantiles.quantile_name(p)] for p in probabilities], want, rtol=1e-9, atol=1e-9)


def test_quantiles_of_a_million_distinct_values_are_narrowed_twice(spark):
    df = spark.range(0, 1_000_000, 1, 8).select((F.col("id") * 7919 % 1_000_003 / 3.0).alias("x"))
    values = np.sort(np.arange(1_000_000, dtype=np.int64) * 7919 % 1_000_003 / 3.0)
    probabilities = [0.0, 0.25, 0.5, 0.999, 1.0]
    for levels in (1, 2):
        r = quantiles.exact_quantiles(df, ["x"], probabilities, levels=levels).first()
        np.testing.assert_allclose([r[quantiles.quantile_name(p)] for p in probabilities], np.quantile(values, probabilities), rtol=1e-12)
    counts = quantiles.value_counts(df, ["x"]).withColumns({"_bucket": F.lit(0).cast("long"), "_start": F.lit(0).cast("long")})
    wanted = F.array(*[F.lit(k) for k in (0, 249_999, 250_000, 499_999, 500_000, 999_999)])
    once = quantiles.narrowed(counts, ["measure"], wanted, [], True)
    sizes = [r["count"] for r in quantiles.narrowed(once, ["measure"], wanted, [], False).groupBy("_bucket").count().collect()]
    # A 64th of a 64th, with room for what a sketch of this accuracy may be off.
    assert max(sizes) <= 3 * 1_000_000 / 64 ** 2 and max(r["count"] for r in once.groupBy("_bucket").count().collect()) <= 1.3 * 1_000_000 / 64


def test_quantiles_of_a_hundred_thousand_groups(spark):
    df = spark.range(0, 500_000, 1, 8).select((F.col("id") % 100_000).alias("g"), (F.col("id") * 31 % 4999).cast("double").alias("x"))
    found = quantiles.exact_quantiles(df, ["x"], [0.5], ["g"])
    assert "broadcast" not in plan_of(found)
    got = {r["g"]: r["q50"] for r in found.where("g % 997 = 0").collect()}
    assert got == {g: float(np.median([i * 31 % 4999 for i in range(g, 500_000, 100_000)])) for g in range(0, 100_000, 997)}
    box = stats.box_numbers(df.withColumnRenamed("x", "dep_delay_s"), "g")
    assert box.count() == 100_000


def test_approximate_quantiles_are_close(spark):
    df = spark.range(1001).select(F.col("id").cast("double").alias("x"))
    got = quantiles.approximate_quantiles(df, ["x"], [0.1, 0.5]).first()
    assert got["n"] == 1001 and abs(got["q10"] - 100) <= 2 and abs(got["q50"] - 500) <= 2


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert quantiles.exact_quantiles(df, ["x"], [0.5]).count() == 0
    filled = df.withColumn("q", quantiles.as_lookup(quantiles.exact_quantiles(df, ["x"], [0.5])))
    assert filled.select(F.col("q")["x"]["q50"]).first()[0] is None


def nearest_by_hand(events, weather):
    out = []
    for i, station, at in events:
        if at is None:
            continue
        own = sorted(t for s, t in weather if s == station and t is not None)
        out.append((i, min(own, key=lambda t: (abs(t - at), t)) if own and station is not None else None))
    return sorted(out, key=lambda r: r[0])


def test_series_of_a_few_far_apart_observations(spark):
    """Days without weather take wider slots instead of a row each."""
    times = [datetime(1900, 1, 1), datetime(2024, 1, 1, 6), datetime(2024, 1, 1, 7), datetime(2300, 1, 1)]
    events = [(i, 1, datetime(1800, 1, 1) + timedelta(days=i * 997, minutes=i * 7)) for i in range(250)]
    left = spark.createDataFrame(events, "id int, station_id int, datetime timestamp_ntz")
    right = spark.createDataFrame([(1, t, n) for n, t in enumerate(times)], "station_id int, valid_time timestamp_ntz, n int")
    got = {r["id"]: times[r["n"]] for r in add_weather(left, right, measures=["n"]).collect()}
    assert got == dict(nearest_by_hand(events, [(1, t) for t in times]))


def test_events_are_shuffled_once_and_not_windowed(spark):
    plan = add_weather(views.timed(spark, SMALL), views.weather(spark, SMALL)).drop("x")._jdf.queryExecution().sparkPlan().toString()
    above = plan[:plan.index("Window")] if "Window" in plan else plan
    assert plan.count("l_partkey") > 0 and "l_partkey" not in plan[plan.index("Window"):]
    assert "Join" in above


@pytest.mark.parametrize("seed", range(4))
def test_nearest_weather_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    start = datetime(2024, 1, 1)
    moment = lambda days: start + timedelta(minutes=rng.randint(0, days * 1440) // 30 * 30)
    events = [(i, rng.choice([1, 1, 1, 2, 3, 4, None]), rng.choice([moment(12), moment(12), None])) for i in range(200)]
    weather = [(rng.choice([1, 2, 3, None]), moment(9)) for _ in range(40)] + [(1, None)]
    left = spark.createDataFrame(events, "id int, station_id int, datetime timestamp_ntz")
    right = spark.createDataFrame([(s, t, float(t.timestamp()) if t else 0.0) for s, t in weather],
                                  "station_id int, valid_time timestamp_ntz, stamp double")
    got = add_weather(left, right, measures=["stamp"], max_rows=[None, 2, 1000, None][seed])
    found = [(r["id"], datetime.fromtimestamp(r["stamp"]) if r["weather_station_found"] else None,
              r["time_diff_minutes"]) for r in got.orderBy("id").collect()]
    assert [f[:2] for f in found] == nearest_by_hand(events, weather)
    at = {i: t for i, _, t in events}
    assert all(d is None if t is None else d == abs((t - at[i]).total_seconds()) / 60 for i, t, d in found)
