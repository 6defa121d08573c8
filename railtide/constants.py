"""Names, types and numbers that are part of the data contract."""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values: raw header -> our name (21 columns, all text) -------------------------------
RAW_COLUMNS = {
    "BETRIEBSTAG": "service_date",
    "FAHRT_BEZEICHNER": "trip_id",
    "BETREIBER_ID": "operator_id",
    "BETREIBER_ABK": "operator_abbr",
    "BETREIBER_NAME": "operator_name",
    "PRODUKT_ID": "product_id",
    "LINIEN_ID": "line_id",
    "LINIEN_TEXT": "line_text",
    "UMLAUF_ID": "rotation_id",
    "VERKEHRSMITTEL_TEXT": "vehicle_type",
    "ZUSATZFAHRT_TF": "extra_flag",
    "FAELLT_AUS_TF": "cancelled_flag",
    "BPUIC": "stop_uic",
    "HALTESTELLEN_NAME": "station_name",
    "ANKUNFTSZEIT": "arr_sched",
    "AN_PROGNOSE": "arr_prog",
    "AN_PROGNOSE_STATUS": "arr_status",
    "ABFAHRTSZEIT": "dep_sched",
    "AB_PROGNOSE": "dep_prog",
    "AB_PROGNOSE_STATUS": "dep_status",
    "DURCHFAHRT_TF": "pass_through_flag",
}

# --- Fixed values: columns left out of the processed table, and the default row filter ---------
EXCLUDED_COLUMNS = [
    "operator_abbr", "trip_id", "product_id", "operator_name", "operator_id",
    "rotation_id", "vehicle_type", "stop_uic", "service_date",
]
LINE_FILTER = {"line_text": ["IC2", "IC3", "IC5", "IC6", "IC8", "IC21", "IC51", "IC61", "IC81"]}
REAL_STATUS = "REAL"

# --- Fixed values: flags, categories and the token a missing category gets ---------------------
FLAG_COLUMNS = ["extra_flag", "cancelled_flag", "pass_through_flag"]
CATEGORY_COLUMNS = ["line_id", "line_text", "station_name"]
FLAG_CODES = {"false": 0, "true": 1, "False": 0, "True": 1}
NULL_CATEGORY = "nan"

# --- Fixed values: sentinels of a station that is not in the gazetteer -------------------------
MISSING_COORDINATE = -999.0
MISSING_GEONAME_ID = -1

# --- Fixed values: type of every column of the processed table, and its original header --------
PROCESSED_TYPES = {
    "extra_flag_encoded": "tinyint",
    "cancelled_flag_encoded": "tinyint",
    "pass_through_flag_encoded": "tinyint",
    "line_id_encoded": "int",
    "line_text_encoded": "int",
    "station_name_encoded": "int",
    "lat": "double",
    "lon": "double",
    "geoname_id": "bigint",
    "arr_delay_s": "double",
    "dep_delay_s": "double",
    "arr_minutes": "smallint",
    "dep_minutes": "smallint",
    "arr_day_of_week": "tinyint",
    "arr_month": "tinyint",
    "arr_is_weekend": "tinyint",
    "dep_day_of_week": "tinyint",
    "dep_month": "tinyint",
    "dep_is_weekend": "tinyint",
}
PROCESSED_HEADERS = {
    "extra_flag_encoded": "ZUSATZFAHRT_TF_encoded",
    "cancelled_flag_encoded": "FAELLT_AUS_TF_encoded",
    "pass_through_flag_encoded": "DURCHFAHRT_TF_encoded",
    "line_id_encoded": "LINIEN_ID_encoded",
    "line_text_encoded": "LINIEN_TEXT_encoded",
    "station_name_encoded": "HALTESTELLEN_NAME_encoded",
    "lat": "STATION_LAT",
    "lon": "STATION_LON",
    "geoname_id": "STATION_GEOID",
    "arr_delay_s": "ARRIVAL_TIME_DIFF_SECONDS",
    "dep_delay_s": "DEPARTURE_TIME_DIFF_SECONDS",
    "arr_minutes": "ANKUNFTSZEIT_MINUTES",
    "dep_minutes": "ABFAHRTSZEIT_MINUTES",
    "arr_day_of_week": "ANKUNFTSZEIT_DAY_OF_WEEK",
    "arr_month": "ANKUNFTSZEIT_MONTH",
    "arr_is_weekend": "ANKUNFTSZEIT_IS_WEEKEND",
    "dep_day_of_week": "ABFAHRTSZEIT_DAY_OF_WEEK",
    "dep_month": "ABFAHRTSZEIT_MONTH",
    "dep_is_weekend": "ABFAHRTSZEIT_IS_WEEKEND",
}

# --- Fixed values: weather measures -------------------------------------------------------------
WEATHER_MEASURES = [
    "temperature_2m", "dewpoint_2m", "wind_speed", "wind_direction", "surface_pressure",
    "solar_radiation", "total_precipitation", "snow_cover", "snowfall", "soil_temperature_1",
]
MODEL_WEATHER = [
    "temperature_2m", "dewpoint_2m", "wind_speed", "wind_direction", "surface_pressure",
    "total_precipitation", "snow_cover", "solar_radiation",
]
IMPACT_WEATHER = [
    "temperature_2m", "wind_speed", "total_precipitation",
    "snow_cover", "surface_pressure", "solar_radiation",
]

# --- Fixed values: delay classes (right-closed upper bounds in seconds) -------------------------
DELAY_CLASSES = [
    (-300, "very_early"),
    (-60, "early"),
    (60, "on_time"),
    (300, "slight_delay"),
    (600, "moderate_delay"),
    (None, "severe_delay"),
]

# --- Fixed values: day periods as [start, end) hours; the last one wraps around midnight --------
DAY_PERIODS = [
    ("Early Morning (4-7)", 4, 7),
    ("Morning Rush (7-10)", 7, 10),
    ("Midday (10-16)", 10, 16),
    ("Evening Rush (16-19)", 16, 19),
    ("Evening (19-23)", 19, 23),
    ("Night (23-4)", 23, 4),
]
RUSH_HOURS = [(7, 9), (16, 18)]

# --- Fixed values: table schemas ----------------------------------------------------------------
GAZETTEER_SCHEMA = T.StructType([
    T.StructField("geonameid", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("ascii_name", T.StringType()),
    T.StructField("alt_names", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
])
WEATHER_SCHEMA = T.StructType(
    [T.StructField("station_id", T.IntegerType()), T.StructField("valid_time", T.TimestampNTZType())]
    + [T.StructField(m, T.FloatType()) for m in WEATHER_MEASURES]
)
TRACKING_SCHEMA = T.StructType([
    T.StructField("encoded_id", T.IntegerType()),
    T.StructField("new_latitude", T.DoubleType()),
    T.StructField("new_longitude", T.DoubleType()),
    T.StructField("date_added", T.StringType()),
    T.StructField("status", T.StringType()),
])

# --- Fixed values: model settings ---------------------------------------------------------------
FEATURE_SUFFIXES = ("_minutes", "_day_of_week", "_month", "_is_weekend", "_encoded")
GEO_FEATURES = ["lat", "lon"]
INGEST_FOREST = {"numTrees": 500, "maxDepth": 20, "minInstancesPerNode": 10}
MERGED_FOREST = {"numTrees": 200, "maxDepth": 20, "minInstancesPerNode": 5}
SEED = 42
TEST_PERCENT = 20

# Rows one task may hold of a single group before the group is split over several tasks.
MAX_GROUP_ROWS = 5_000_000
# Rows a lookup table may have to be broadcast; larger lookups are joined by shuffle.
MAX_BROADCAST_ROWS = 1_000_000
