"""Stop events, weather, gazetteer and tracking in the shape the engine expects.

Each view is derived from whole tables; ``sql.py`` has the same views for DuckDB.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from railtide.constants import RAW_COLUMNS
from railtide.functions.times import synthetic_datetime, with_delays_and_times
from railtide.functions.values import journey_id
from railtide.operators.asof import add_weather
from railtide.operators.encode import encode_flags
from railtide.plans.features import build_features
from railtide.session import store

ORDER = ["dep_minutes", "row_key"]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def stops(spark: SparkSession, sf: str) -> DataFrame:
    base = (
        table(spark, sf, "lineitem")
        .join(table(spark, sf, "orders"), F.expr("l_orderkey = o_orderkey"))
        .join(table(spark, sf, "supplier"), F.expr("l_suppkey = s_suppkey"))
    )
    minute = "((l_partkey * 7 + l_linenumber * 53) % 1440)"
    arr_late = "((l_partkey * 29 + l_suppkey * 13 + l_linenumber * 89) % 1400 - 240)"
    dep_late = "((l_partkey * 31 + l_suppkey * 17 + l_linenumber * 101) % 1500 - 300)"
    return base.selectExpr(
        "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, cast(l_quantity as int),"
        " cast(round(l_extendedprice * 100) as bigint)) as row_key",
        "l_orderkey", "l_linenumber", "l_partkey",
        "cast(l_orderkey % 40 as int) as line_id",
        "case when l_orderkey % 41 = 0 then null else concat('IC', cast(l_orderkey % 12 as string)) end as line_text",
        "s_name as station_name", "cast(l_suppkey as int) as station_id",
        "case when l_returnflag = 'R' then 'PROGNOSE' else 'REAL' end as arr_status",
        "case when l_linenumber = 7 then 'UNBEKANNT' else 'REAL' end as dep_status",
        "case when l_linestatus = 'F' then 'true' else 'False' end as extra_flag",
        "case when l_linenumber = 6 then 'TRUE' else 'false' end as cancelled_flag",
        "case when l_linenumber = 3 then null else 'FALSE' end as pass_through_flag",
        f"timestampadd(SECOND, {minute} * 60 - 120, o_orderdate) as arr_sched",
        f"timestampadd(SECOND, {minute} * 60 - 120 + {arr_late}, o_orderdate) as arr_prog",
        f"timestampadd(SECOND, {minute} * 60, o_orderdate) as dep_sched",
        f"timestampadd(SECOND, {minute} * 60 + {dep_late}, o_orderdate) as dep_prog",
        "cast(case when l_suppkey % 10 = 0 then -999.0 else 45.0 + s_nationkey * 0.1 + l_suppkey * 0.001 end as double) as lat",
        "cast(case when l_suppkey % 10 = 0 then -999.0 else 6.0 + s_nationkey * 0.15 + l_suppkey * 0.002 end as double) as lon",
    )


def day_first(ts: str, length: int):
    """Text like 31.12.2024 23:59:59, cut to ``length``; the same in every session zone."""
    iso = F.col(ts).cast("string")
    text = F.concat(F.substring(iso, 9, 2), F.lit("."), F.substring(iso, 6, 2), F.lit("."),
                    F.substring(iso, 1, 4), F.substring(iso, 11, 9))
    return F.substring(text, 1, length)


def raw_stops(spark: SparkSession, sf: str) -> DataFrame:
    """The stops as a dump: German header, everything text, day-first times."""
    short, full = 16, 19
    text = {
        "service_date": day_first("dep_sched", 10),
        "trip_id": F.concat_ws(":", F.lit("85"), "l_orderkey", "row_key"),
        "operator_id": F.lit("85:11"), "operator_abbr": F.lit("SB"), "operator_name": F.lit("Bahn"),
        "product_id": F.lit("Zug"), "line_id": F.col("line_id").cast("string"),
        "line_text": F.col("line_text"), "rotation_id": F.col("l_linenumber").cast("string"),
        "vehicle_type": F.lit("IC"), "extra_flag": F.col("extra_flag"),
        "cancelled_flag": F.col("cancelled_flag"), "stop_uic": F.col("station_id").cast("string"),
        "station_name": F.col("station_name"),
        "arr_sched": day_first("arr_sched", short), "arr_prog": day_first("arr_prog", full),
        "arr_status": F.col("arr_status"),
        "dep_sched": day_first("dep_sched", short), "dep_prog": day_first("dep_prog", full),
        "dep_status": F.col("dep_status"), "pass_through_flag": F.col("pass_through_flag"),
    }
    return stops(spark, sf).select(*[text[ours].alias(header) for header, ours in RAW_COLUMNS.items()])


def timed(spark: SparkSession, sf: str) -> DataFrame:
    """Stops with delays, calendar features, rebuilt datetime and journey."""
    df = with_delays_and_times(stops(spark, sf))
    at = synthetic_datetime(F.col("dep_month"), F.col("dep_day_of_week"), F.col("dep_minutes"))
    df = df.withColumn("datetime", at)
    return df.withColumn("journey_id", journey_id(
        "date_line", F.col("datetime"), F.col("line_id"), F.col("dep_minutes")))


def weather(spark: SparkSession, sf: str) -> DataFrame:
    """The first three stations have no weather."""
    return table(spark, sf, "events").selectExpr(
        "cast(user_id + 3 as int) as station_id", "ts as valid_time", "event_id",
        "value as temperature_2m", "value - 5 as dewpoint_2m",
        "cast((event_id * 13) % 30 as double) as wind_speed",
        "cast((event_id * 47) % 360 as double) as wind_direction",
        "cast(950 + (event_id * 7) % 80 as double) as surface_pressure",
        "cast((event_id * 19) % 800 as double) as solar_radiation",
        "case when event_id % 11 = 0 then null else cast((event_id * 3) % 20 as double) end as total_precipitation",
        "case when event_id % 17 = 0 then null else cast((event_id * 17) % 100 as double) end as snow_cover",
        "cast((event_id * 23) % 5 as double) as snowfall",
        "value * 0.5e0 as soil_temperature_1",
    )


def gazetteer(spark: SparkSession, sf: str) -> DataFrame:
    """Every tenth place has another name than its station, and ``Shared-`` names collide."""
    return table(spark, sf, "supplier").join(
        table(spark, sf, "nation"), F.expr("s_nationkey = n_nationkey")).selectExpr(
        "1000000 + s_suppkey as geonameid",
        "case when s_suppkey % 10 = 0 then concat('Halt ', s_name) else s_name end as name",
        "case when s_suppkey % 10 = 0 then concat('Halt ', s_name) else s_name end as ascii_name",
        "concat(n_name, '-', cast(s_suppkey as string), ',', 'Shared-', cast(s_suppkey % 5 as string)) as alt_names",
        "cast(45.0 + s_nationkey * 0.1 + s_suppkey * 0.001 as double) as latitude",
        "cast(6.0 + s_nationkey * 0.15 + s_suppkey * 0.002 as double) as longitude",
        "s_suppkey as line_no",
    )


def tracking(spark: SparkSession, sf: str) -> DataFrame:
    """Stations of some countries are tracked already; the missing ones of the others are new."""
    some = table(spark, sf, "supplier").where("s_nationkey < 15").select(F.col("s_suppkey").alias("line_no"))
    return every_tracking(spark, sf).join(some, "line_no", "left_semi")


def every_tracking(spark: SparkSession, sf: str) -> DataFrame:
    """All stations are tracked, some with coordinates, some ruled out."""
    return table(spark, sf, "supplier").selectExpr(
        "cast(s_suppkey as int) as encoded_id",
        "case when s_suppkey % 4 = 0 then cast(46.5 as double) end as new_latitude",
        "case when s_suppkey % 4 = 0 then cast(7.5 as double) end as new_longitude",
        "'2024-11-01' as date_added",
        "case when s_suppkey % 5 = 3 then 'invalid' else 'pending' end as status",
        "s_suppkey as line_no",
    )


def merged(spark: SparkSession, sf: str) -> DataFrame:
    """Timed stops with the nearest weather."""
    return add_weather(timed(spark, sf), weather(spark, sf).drop("event_id"))


# What features are made from, and what tells rows and their order.
FEATURE_SOURCES = [
    "row_key", "datetime", "dep_minutes", "line_id_encoded", "station_name_encoded", "lat", "lon",
    "wind_speed", "total_precipitation", "temperature_2m", "dewpoint_2m", "arr_delay_s", "dep_delay_s",
]


def features(spark: SparkSession, sf: str, wanted: list[str] | None = None) -> DataFrame:
    """The table models are trained on; with ``wanted`` only these columns of it and what they are made from
    are stored and shuffled."""
    df = encode_flags(merged(spark, sf)).withColumns({
        "line_id_encoded": F.col("line_id"), "station_name_encoded": F.col("station_id"),
        "line_text_encoded": F.substring("line_text", 3, 2).try_cast("int")})
    if wanted is not None:
        df = df.select(*[c for c in df.columns if c in {*wanted, *FEATURE_SOURCES}])
    built = build_features(store(df, "merged"), ORDER)
    return built if wanted is None else built.select(*[c for c in built.columns if c in wanted])
