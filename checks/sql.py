"""The queries of ``queries.py`` as DuckDB SQL."""

from __future__ import annotations

from railtide.models.features import COMPACT_FEATURES
from railtide.constants import IMPACT_WEATHER, MODEL_WEATHER, RAW_COLUMNS, WEATHER_MEASURES

MINUTE = "((l_partkey * 7 + l_linenumber * 53) % 1440)"
ARR_LATE = "((l_partkey * 29 + l_suppkey * 13 + l_linenumber * 89) % 1400 - 240)"
DEP_LATE = "((l_partkey * 31 + l_suppkey * 17 + l_linenumber * 101) % 1500 - 300)"

VIEWS = {
    "stops": f"""
select concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, cast(l_quantity as int),
    cast(round(l_extendedprice * 100) as bigint)) as row_key,
  l_orderkey, l_linenumber, l_partkey, cast(l_orderkey % 40 as int) as line_id,
  case when l_orderkey % 41 = 0 then null else concat('IC', cast(l_orderkey % 12 as varchar)) end as line_text,
  s_name as station_name, cast(l_suppkey as int) as station_id,
  case when l_returnflag = 'R' then 'PROGNOSE' else 'REAL' end as arr_status,
  case when l_linenumber = 7 then 'UNBEKANNT' else 'REAL' end as dep_status,
  case when l_linestatus = 'F' then 'true' else 'False' end as extra_flag,
  case when l_linenumber = 6 then 'TRUE' else 'false' end as cancelled_flag,
  case when l_linenumber = 3 then null else 'FALSE' end as pass_through_flag,
  o_orderdate + to_seconds({MINUTE} * 60 - 120) as arr_sched,
  o_orderdate + to_seconds({MINUTE} * 60 - 120 + {ARR_LATE}) as arr_prog,
  o_orderdate + to_seconds({MINUTE} * 60) as dep_sched,
  o_orderdate + to_seconds({MINUTE} * 60 + {DEP_LATE}) as dep_prog,
  cast(case when l_suppkey % 10 = 0 then -999.0 else 45.0 + s_nationkey * 0.1 + l_suppkey * 0.001 end as double) as lat,
  cast(case when l_suppkey % 10 = 0 then -999.0 else 6.0 + s_nationkey * 0.15 + l_suppkey * 0.002 end as double) as lon
from lineitem join orders on l_orderkey = o_orderkey join supplier on l_suppkey = s_suppkey""",
    "raw": """
select strftime(dep_sched, '%d.%m.%Y') as service_date, concat_ws(':', '85', l_orderkey, row_key) as trip_id,
  '85:11' as operator_id, 'SB' as operator_abbr, 'Bahn' as operator_name, 'Zug' as product_id,
  cast(line_id as varchar) as line_id, line_text, cast(l_linenumber as varchar) as rotation_id,
  'IC' as vehicle_type, extra_flag, cancelled_flag, cast(station_id as varchar) as stop_uic, station_name,
  strftime(arr_sched, '%d.%m.%Y %H:%M') as arr_sched, strftime(arr_prog, '%d.%m.%Y %H:%M:%S') as arr_prog, arr_status,
  strftime(dep_sched, '%d.%m.%Y %H:%M') as dep_sched, strftime(dep_prog, '%d.%m.%Y %H:%M:%S') as dep_prog, dep_status,
  pass_through_flag
from stops""",
    "base": """
select *, cast(date_diff('second', arr_sched, arr_prog) as double) as arr_delay_s,
  cast(date_diff('second', dep_sched, dep_prog) as double) as dep_delay_s,
  cast(hour(arr_sched) * 60 + minute(arr_sched) as smallint) as arr_minutes,
  cast(isodow(arr_sched) - 1 as tinyint) as arr_day_of_week, cast(month(arr_sched) as tinyint) as arr_month,
  cast(isodow(arr_sched) >= 6 as tinyint) as arr_is_weekend,
  cast(hour(dep_sched) * 60 + minute(dep_sched) as smallint) as dep_minutes,
  cast(isodow(dep_sched) - 1 as tinyint) as dep_day_of_week, cast(month(dep_sched) as tinyint) as dep_month,
  cast(isodow(dep_sched) >= 6 as tinyint) as dep_is_weekend
from stops""",
    "timed": """
select *, strftime(datetime, '%Y-%m-%d') || '_' || line_id || '_0' as journey_id from (
  select *, cast(make_date(2024, dep_month, 1) as timestamp)
    + to_days(cast(case when dep_day_of_week < isodow(make_date(2024, dep_month, 1))
      then dep_day_of_week - isodow(make_date(2024, dep_month, 1)) + 7
      else dep_day_of_week - isodow(make_date(2024, dep_month, 1)) end as int))
    + to_minutes(cast(dep_minutes as bigint)) as datetime
  from base)""",
    "weather": """
select cast(user_id + 3 as int) as station_id, ts as valid_time, event_id,
  value as temperature_2m, value - 5 as dewpoint_2m,
  cast((event_id * 13) % 30 as double) as wind_speed, cast((event_id * 47) % 360 as double) as wind_direction,
  cast(950 + (event_id * 7) % 80 as double) as surface_pressure,
  cast((event_id * 19) % 800 as double) as solar_radiation,
  case when event_id % 11 = 0 then null else cast((event_id * 3) % 20 as double) end as total_precipitation,
  case when event_id % 17 = 0 then null else cast((event_id * 17) % 100 as double) end as snow_cover,
  cast((event_id * 23) % 5 as double) as snowfall, value * 0.5e0 as soil_temperature_1
from events""",
    "gazetteer": """
select 1000000 + s_suppkey as geonameid,
  case when s_suppkey % 10 = 0 then concat('Halt ', s_name) else s_name end as name,
  case when s_suppkey % 10 = 0 then concat('Halt ', s_name) else s_name end as ascii_name,
  concat(n_name, '-', cast(s_suppkey as varchar), ',', 'Shared-', cast(s_suppkey % 5 as varchar)) as alt_names,
  cast(45.0 + s_nationkey * 0.1 + s_suppkey * 0.001 as double) as latitude,
  cast(6.0 + s_nationkey * 0.15 + s_suppkey * 0.002 as double) as longitude, s_suppkey as line_no
from supplier join nation on s_nationkey = n_nationkey""",
    "aliases": """
select alias, arg_max(latitude, line_no) as latitude, arg_max(longitude, line_no) as longitude,
  arg_max(geonameid, line_no) as geonameid
from (select unnest(list_concat([name, ascii_name], string_split(alt_names, ','))) as alias, * from gazetteer)
where alias <> '' group by alias""",
    "tracking": "select * from every_tracking where line_no in (select s_suppkey from supplier where s_nationkey < 15)",
    "every_tracking": """
select cast(s_suppkey as int) as encoded_id,
  case when s_suppkey % 4 = 0 then cast(46.5 as double) end as new_latitude,
  case when s_suppkey % 4 = 0 then cast(7.5 as double) end as new_longitude,
  '2024-11-01' as date_added, case when s_suppkey % 5 = 3 then 'invalid' else 'pending' end as status,
  s_suppkey as line_no
from supplier""",
    "refreshed": "select * from every_refreshed where line_no in (select line_no from tracking)",
    "every_refreshed": """
select encoded_id, new_latitude, new_longitude, date_added,
  case when status = 'pending' and new_latitude is not null and new_longitude is not null then 'updated'
    else status end as status, line_no
from every_tracking""",
    "missing": "select distinct station_id as encoded_id from stops where lat = -999 or lon = -999",
    "tracked": """
select encoded_id, new_latitude, new_longitude, date_added, status, false as is_new from refreshed
union all select encoded_id, null, null, '2024-12-01', 'pending', true from missing
  where encoded_id not in (select encoded_id from tracking)""",
    "points": "select distinct station_id, datetime from timed",
    "nearest": """
select p.station_id, p.datetime, case when b.valid_time is null
    or date_diff('microsecond', p.datetime, a.valid_time) < date_diff('microsecond', b.valid_time, p.datetime)
  then a.valid_time else b.valid_time end as valid_time
from points p
asof left join weather b on p.station_id = b.station_id and p.datetime >= b.valid_time
asof left join weather a on p.station_id = a.station_id and p.datetime <= a.valid_time""",
    "merged": f"""
select t.*, {', '.join('w.' + m for m in WEATHER_MEASURES)},
  abs(date_diff('microsecond', n.valid_time, t.datetime)) / 60e6 as time_diff_minutes,
  n.valid_time is not null as weather_station_found
from timed t join nearest n on t.station_id = n.station_id and t.datetime = n.datetime
left join weather w on w.station_id = n.station_id and w.valid_time = n.valid_time""",
    "stats": """
select station_id, count(arr_delay_s) as arr_delay_s_count, avg(arr_delay_s) as arr_delay_s_mean,
  stddev_samp(arr_delay_s) as arr_delay_s_std, count(dep_delay_s) as dep_delay_s_count,
  avg(dep_delay_s) as dep_delay_s_mean, stddev_samp(dep_delay_s) as dep_delay_s_std,
  count(arr_delay_s) / max(count(arr_delay_s)) over () * 300 as bubble_size
from timed group by station_id""",
    "tall": """
select 'Arrival' as kind, cast(arr_minutes as int) as minutes, arr_delay_s as delay_s, 'arr_delay_s' as measure from timed
union all select 'Departure', cast(dep_minutes as int), dep_delay_s, 'dep_delay_s' from timed""",
    "by_minute": "select kind, minutes, avg(delay_s) as mean_delay_s from tall group by all",
    "by_hour": "select kind, minutes // 60 as hour, avg(mean_delay_s / 60) as delay_min from by_minute group by all",
    "by_period": """
select kind, case when hour >= 23 or hour < 4 then 'Night (23-4)' when hour < 7 then 'Early Morning (4-7)'
  when hour < 10 then 'Morning Rush (7-10)' when hour < 16 then 'Midday (10-16)'
  when hour < 19 then 'Evening Rush (16-19)' else 'Evening (19-23)' end as period, avg(delay_min) as delay_min
from by_hour group by all""",
    "legs": """
select *, coalesce(sqrt(pow(lead(lat) over j - lat, 2) + pow(lead(lon) over j - lon, 2)), 0) as leg,
  row_number() over j - 1 as seq, count(*) over (partition by journey_id) as stops_total,
  lag(dep_delay_s) over j as prev
from timed window j as (partition by journey_id order by dep_minutes, row_key)""",
    "runs": """
select *, sum(leg) over (partition by journey_id order by dep_minutes, row_key
  rows between unbounded preceding and current row) as run from legs""",
}

# Which views a view reads.
NEEDS = {
    "raw": ["stops"], "base": ["stops"], "timed": ["base"], "aliases": ["gazetteer"],
    "tracking": ["every_tracking"], "every_refreshed": ["every_tracking"],
    "refreshed": ["every_refreshed", "tracking"], "missing": ["stops"], "tracked": ["refreshed", "missing"],
    "points": ["timed"], "nearest": ["points", "weather"], "merged": ["nearest"],
    "stats": ["timed"], "tall": ["timed"], "by_minute": ["tall"], "by_hour": ["by_minute"],
    "by_period": ["by_hour"], "legs": ["timed"], "runs": ["legs"],
}


def over(*views: str, sql: str) -> str:
    """The statement with the views it needs in front of it."""
    order: list[str] = []

    def add(name: str) -> None:
        for needed in NEEDS.get(name, []):
            add(needed)
        if name not in order:
            order.append(name)

    for name in views:
        add(name)
    return "with " + ",\n".join(f"{n} as ({VIEWS[n].strip()})" for n in order) + "\n" + sql.strip()


def r6(expression: str, name: str | None = None) -> str:
    return f"round(cast({expression} as double), 6) + 0e0 as {name or expression}"


def quantile(p: float, column: str) -> str:
    return f"quantile_cont({column}, {p})"


STATION_COLUMNS = ", ".join(
    ["station_id", "arr_delay_s_count", "dep_delay_s_count"]
    + [r6(c) for c in ("arr_delay_s_mean", "arr_delay_s_std", "dep_delay_s_mean", "dep_delay_s_std", "bubble_size")])


def density(measure_rows: str) -> str:
    """Kernel density of ``(measure, value)`` rows, in minutes."""
    return f""", vals as (select measure, value / 60 as value, count(*) as n from ({measure_rows})
  where value is not null group by all),
shape as (select measure, sum(n) as total, min(value) as lo, max(value) as hi,
  sqrt((sum(n * value * value) - pow(sum(n * value), 2) / sum(n)) / (sum(n) - 1)) * pow(sum(n), -0.2) as h
  from vals group by measure),
grid as (select measure, total, h, cast(i as int) as point, lo - 3 * h + i * ((hi - lo + 6 * h) / 199) as x
  from shape, range(200) r(i))
select measure, point, {r6('x')},
  {r6('sum(n * exp(-0.5 * pow((x - value) / h, 2))) / (any_value(total) * any_value(h) * sqrt(2 * pi()))', 'density')}
from grid join vals using (measure) group by measure, point, x"""


def moments(column: str) -> str:
    x = column
    return f"""select '{x}' as measure, {r6(f'avg({x}) / 60', 'mean')}, {r6(f'stddev_samp({x}) / 60', 'std')},
  {r6(f'(avg(pow({x}, 3)) - 3 * avg({x}) * avg({x} * {x}) + 2 * pow(avg({x}), 3)) / pow(var_pop({x}), 1.5)', 'skew')},
  {r6(f'kurtosis_pop({x})', 'kurtosis')}, {r6(f'quantile_cont({x}, 0.5) / 60', 'median')},
  {r6(f'quantile_cont({x}, 0.9) / 60', 'q90')}, {r6(f'quantile_cont({x}, 0.95) / 60', 'q95')} from timed"""


def describe(column: str) -> str:
    return f"""select '{column}' as "column", count(*) as "rows", count({column}) as non_missing,
  {r6(f'avg({column})', 'mean')}, {r6(f'stddev_samp({column})', 'std')}, {r6(f'min({column})', 'min')},
  {r6(f'max({column})', 'max')} from (select lat, lon, l_orderkey as geoname_id from stops)"""


def flag(column: str) -> str:
    return f"cast(case lower({column}) when 'true' then 1 when 'false' then 0 end as tinyint) as {column}_encoded"


FLAGS = [flag(c) for c in ("extra_flag", "cancelled_flag", "pass_through_flag")]


def code(column: str, name: str | None = None) -> str:
    return (f"cast(dense_rank() over (order by coalesce(cast({column} as varchar), 'nan')) - 1 as int)"
            f" as {name or column}_encoded")


def profile(column: str) -> str:
    return f"""select '{column}' as "column", count(*) as total_rows, count(distinct {column}) as unique_values,
  cast(min({column}) as bigint) as min_code, cast(max({column}) as bigint) as max_code, 6 as columns from coded"""


def parts(column: str) -> str:
    return ", ".join(f"cast({f}({column}){shift} as int) as {column}_{name}" for name, f, shift in (
        ("day", "day", ""), ("month", "month", ""), ("year", "year", ""), ("weekday", "isodow", " - 1"),
        ("hour", "hour", ""), ("minute", "minute", "")))


def clipped(c: str) -> str:
    lo, hi = (f"(q.{c}[2] {sign} 1.5 * (q.{c}[3] - q.{c}[1]))" for sign in "-+")
    return r6(f"case when w.{c} is null then q.{c}[2] else least(greatest(w.{c}, {lo}), {hi}) end", c)


SCALED = ["temperature_2m", "wind_speed", "total_precipitation", "surface_pressure"]
QUARTILES = ", ".join(f"quantile_cont({c}, [0.25, 0.5, 0.75]) as {c}" for c in MODEL_WEATHER)
HASH = "cast('0x' || substr(md5(row_key), 1, 8) as bigint)"
COVERAGE = ("count(*) as total, count(*) filter (weather_station_found) as with_weather,"
            " count(*) filter (not weather_station_found) as missing_weather, "
            + r6("count(*) filter (weather_station_found) * 100e0 / count(*)", "coverage_percentage"))
FOLD_CASES = "case when n - p <= t then 3 when n - p <= 2 * t then 2 when n - p <= 3 * t then 1 else 0 end"

# Importances of two models by formula, one row per country and model.
IMPORTANCES = """
select m.model, case p_partkey % 25 when 3 then 'lat' when 7 then 'lon' else concat(p_brand, ' ', p_size) end as feature,
  cast((p_partkey * m.k) % 31 as double) / 100 as importance
from part, (values ('arrival', 7), ('departure', 11)) m(model, k)"""

ORACLE = {
    # sources and sinks
    "scan_csv": over("raw", sql="select * from raw"),
    "scan_exclude_columns": over("raw", sql="""
select line_id, line_text, extra_flag, cancelled_flag, station_name, arr_sched, arr_prog, arr_status,
  dep_sched, dep_prog, dep_status, pass_through_flag from raw"""),
    "scan_parquet": "select * from lineitem",
    "scan_weather": over("weather", sql="select station_id, valid_time, " + ", ".join(
        f"cast({m} as float) as {m}" for m in WEATHER_MEASURES) + " from weather"),
    "scan_gazetteer": over("gazetteer", sql="""
select geonameid, name, ascii_name, alt_names, latitude, longitude from gazetteer"""),
    "recent_months": over("stops", sql="""
select row_key, dep_sched from stops where strftime(dep_sched, '%Y-%m') in
  (select strftime(date '2001-08-15' - cast(30 * i as int), '%Y-%m') from range(11) r(i))"""),
    "sink_parquet": over("stops", sql="""
select row_key, station_name, lat, dep_sched, strftime(dep_sched, '%Y-%m') as service_month from stops"""),
    "sink_chunked": over("stops", sql="select row_key, station_id, lat, lon from stops"),
    "sink_csv": over("stops", sql="""
select distinct station_id, lat as latitude, lon as longitude from stops"""),
    "tracking_open": over("missing", sql="""
select encoded_id, cast(null as double) as new_latitude, cast(null as double) as new_longitude,
  '2024-12-01' as date_added, 'pending' as status from missing"""),
    "summary_json": over("timed", sql=(moments("arr_delay_s") + " union all " + moments("dep_delay_s")).replace(" / 60", "")),
    "sink_versioned": over("stops", "every_refreshed", sql="""
select row_key, station_id, coalesce(new_latitude, lat) as lat, coalesce(new_longitude, lon) as lon
from stops left join (select * from every_refreshed where status = 'updated') on station_id = encoded_id"""),
    "encoding_table": over("stops", sql=" union all ".join(
        f"""select '{c}' as "column", value, cast(dense_rank() over (order by value) - 1 as int) as code
from (select distinct coalesce(cast({c} as varchar), 'nan') as value from stops)"""
        for c in ("line_id", "line_text", "station_name")) + " union all " + """
select f, value, code from (values ('extra_flag'), ('cancelled_flag'), ('pass_through_flag')) a(f),
  (values ('false', 0), ('true', 1), ('False', 0), ('True', 1)) b(value, code)"""),
    # rows
    "drop_columns": over("stops", sql="select row_key, line_id, lat from stops"),
    "filter_in_list": over("stops", sql="""
select row_key, line_text, dep_status from stops
where line_text in ('IC2', 'IC3', 'IC5', 'IC6', 'IC8') and dep_status = 'REAL'"""),
    "filter_real_status": over("stops", sql="""
select row_key, station_id from stops where arr_status = 'REAL' and dep_status = 'REAL'"""),
    "cast_output": over("timed", sql="""
select row_key, lat, arr_delay_s, dep_minutes, dep_month, dep_is_weekend, l_orderkey as geoname_id,
  line_id as line_id_encoded from timed"""),
    "coerce_numeric": over("stops", sql="""
select row_key, case when l_linenumber = 2 then null else cast(l_orderkey as double) end as x from stops"""),
    "impute_median_zero": over("weather", sql="""
select event_id, coalesce(total_precipitation, (select median(total_precipitation) from weather)) as total_precipitation,
  coalesce(snow_cover, 0) as snow_cover from weather"""),
    "fill_numeric_zero": over("weather", sql="""
select event_id, coalesce(total_precipitation, 0) as total_precipitation, coalesce(snow_cover, 0) as snow_cover
from weather"""),
    "select_features": over("timed", sql=f"""
select {', '.join(FLAGS)}, lat, lon, arr_minutes, arr_day_of_week, arr_month, arr_is_weekend,
  dep_minutes, dep_day_of_week, dep_month, dep_is_weekend from timed"""),
    "outlier_sigma": over("weather", sql="""
select event_id, temperature_2m from weather, (select avg(temperature_2m) m, stddev_samp(temperature_2m) s from weather)
where abs(temperature_2m - m) <= 3 * s"""),
    "outlier_iqr": over("weather", sql="""
select event_id, temperature_2m from weather,
  (select quantile_cont(temperature_2m, 0.25) a, quantile_cont(temperature_2m, 0.75) b from weather)
where temperature_2m between a - 3 * (b - a) and b + 3 * (b - a)"""),
    "clip_iqr": over("weather", sql=f"""
select event_id, {', '.join(clipped(c) for c in MODEL_WEATHER)} from weather w, (select {QUARTILES} from weather) q"""),
    "cast_float32": over("weather", sql="""
select event_id, cast(temperature_2m as float) as temperature_2m, cast(wind_speed as float) as wind_speed from weather"""),
    "union_files": over("stops", sql="""
select row_key, arr_sched, cast(null as timestamp) as dep_sched, cast(null as int) as station_id from stops
union all select row_key, null, dep_sched, station_id from stops"""),
    # joins
    "geo_enrich": over("stops", "aliases", sql=f"""
select row_key, station_name, {r6('coalesce(latitude, -999)', 'lat')}, {r6('coalesce(longitude, -999)', 'lon')},
  coalesce(geonameid, -1) as geoname_id from stops left join aliases on station_name = alias"""),
    "gazetteer_alias": over("aliases", sql=f"""
select alias, {r6('latitude')}, {r6('longitude')}, geonameid from aliases"""),
    "asof_nearest": over("merged", sql=f"""
select row_key, station_id, datetime, {', '.join(r6(m) for m in WEATHER_MEASURES)},
  round(cast(cast(time_diff_minutes as float) as double), 2) as time_diff_minutes, weather_station_found from merged"""),
    "asof_duplicates": over("merged", sql=f"""
select row_key, station_id, datetime, {', '.join(r6(m) for m in WEATHER_MEASURES)},
  round(cast(cast(time_diff_minutes as float) as double), 2) as time_diff_minutes, weather_station_found from merged"""),
    "tracking_new": over("tracked", sql="select encoded_id, new_latitude, new_longitude, date_added, status from tracked"),
    "tracking_status": over("every_refreshed", sql="""
select encoded_id, new_latitude, new_longitude, date_added, status from every_refreshed"""),
    "apply_corrections": over("stops", "every_refreshed", sql=f"""
select row_key, station_id, {r6('coalesce(new_latitude, lat)', 'lat')}, {r6('coalesce(new_longitude, lon)', 'lon')}
from stops left join (select * from every_refreshed where status = 'updated') on station_id = encoded_id"""),
    "decode_category": over("stops", sql=f"select row_key, {code('station_name')}, station_name from stops"),
    # aggregates
    "station_delay_stats": over("stats", sql=f"""
select {STATION_COLUMNS}, s_name as station_name from stats join supplier on station_id = s_suppkey"""),
    "delay_stats": over("timed", sql=moments("arr_delay_s") + " union all " + moments("dep_delay_s")),
    "delay_by_minute": over("by_minute", sql=f"select kind, minutes, {r6('mean_delay_s')} from by_minute"),
    "delay_by_hour": over("by_hour", sql=f"select kind, cast(hour as int) as hour, {r6('delay_min')} from by_hour"),
    "delay_by_period": over("by_period", sql=f"select kind, period, {r6('delay_min')} from by_period"),
    "extreme_periods": over("by_period", sql=f"""
(select 'highest' as extreme, period, kind, {r6('delay_min')} from by_period order by by_period.delay_min desc limit 1)
union all
(select 'lowest', period, kind, {r6('delay_min')} from by_period order by by_period.delay_min limit 1)"""),
    "hourly_trend": over("by_hour", sql=f"""
select kind, cast(hour as int) as hour, {r6('delay_min')},
  {r6('case when count(delay_min) over w = 3 then avg(delay_min) over w end', 'trend_min')}
from by_hour window w as (partition by kind order by hour rows between 1 preceding and 1 following)"""),
    "weather_coverage": over("merged", sql=f"""
select 'all' as level, cast(null as int) as month, cast(null as int) as station_id, {COVERAGE} from merged
union all select 'month', cast(dep_month as int), null, {COVERAGE} from merged group by dep_month
union all select 'station', null, station_id, {COVERAGE} from merged group by station_id"""),
    "stations_without_weather": over("merged", sql="""
select distinct station_id from merged where not weather_station_found"""),
    "weather_time_diff_stats": over("merged", sql="""
select round(avg(d), 2) as mean, round(quantile_cont(d, 0.5), 2) as median, round(max(d), 2) as max, round(min(d), 2) as min
from (select cast(cast(time_diff_minutes as float) as double) as d from merged where weather_station_found)"""),
    "station_mapping": over("stops", sql=f"""
select distinct station_id, {r6('lat', 'latitude')}, {r6('lon', 'longitude')} from stops"""),
    "missing_stations": over("missing", sql="select encoded_id from missing"),
    "tracking_summary": over("tracked", sql="""
select count(*) as total, count(*) filter (is_new) as new_stations, count(*) filter (status = 'pending') as pending,
  count(*) filter (status = 'updated') as updated, count(*) filter (status = 'invalid') as invalid from tracked"""),
    "dataset_profile": over("timed", sql=f""", coded as (select {', '.join(FLAGS)}, line_id as line_id_encoded,
  station_id as station_name_encoded from timed)
select '*' as "column", count(*) as total_rows, 0 as unique_values, cast(null as bigint) as min_code,
  cast(null as bigint) as max_code, 6 as columns from coded union all """ + " union all ".join(
        profile(f"{c}_encoded") for c in ("extra_flag", "cancelled_flag", "pass_through_flag", "line_id", "station_name"))),
    "geo_describe": over("stops", sql=" union all ".join(describe(c) for c in ("lat", "lon", "geoname_id"))),
    "station_mean_summary": over("stats", sql=" union all ".join(f"""
select '{m}' as measure, {r6(f'avg({m}) / 60', 'mean')}, {r6(f'stddev_samp({m}) / 60', 'std')},
  {r6(f'median({m}) / 60', 'median')} from stats""" for m in ("arr_delay_s_mean", "dep_delay_s_mean"))),
    "outlier_stations": over("stats", sql=f"""
select {STATION_COLUMNS} from stats, (select quantile_cont(arr_delay_s_mean, 0.95) as q from stats)
where stats.arr_delay_s_mean > q or stats.dep_delay_s_mean > q"""),
    "top_stations": over("stats", sql=f"""
select {STATION_COLUMNS} from (select * from stats order by arr_delay_s_mean desc nulls last, station_id limit 15)"""),
    "delay_histogram": over("tall", sql=f""", m as (select max(abs(delay_s)) as m from tall)
select k.measure, cast(b as int) as bin, {r6('b * (m * 2 / 49) - m', 'left_edge')}, cast(count(bin) as bigint) as n
from (select distinct measure from tall) k cross join range(49) r(b) cross join m
left join (select measure, least(floor((delay_s + m) / (m * 2 / 49)), 48) as bin from tall, m where delay_s is not null) f
  on f.measure = k.measure and f.bin = b group by all"""),
    "delay_kde": over("tall", sql=density("select measure, delay_s as value from tall")),
    "station_mean_kde": over("stats", sql=density("""
select 'arr_delay_s_mean' as measure, arr_delay_s_mean as value from stats
union all select 'dep_delay_s_mean', dep_delay_s_mean from stats""")),
    "on_time_rate": over("timed", sql=f"""
select {r6('100 * avg(cast(coalesce(abs(arr_delay_s) <= 60, false) as double))', 'arrival_pct')},
  {r6('100 * avg(cast(coalesce(abs(dep_delay_s) <= 60, false) as double))', 'departure_pct')} from timed"""),
    "rush_hour_box": over("timed", sql=""", flagged as (select dep_delay_s as d,
  cast((dep_minutes // 60 between 7 and 9) or (dep_minutes // 60 between 16 and 18) as int) as rush_hour from timed),
box as (select rush_hour, count(d) as n, quantile_cont(d, 0.25) as q25, quantile_cont(d, 0.5) as q50,
  quantile_cont(d, 0.75) as q75 from flagged group by rush_hour)
select rush_hour, n, q25, q50, q75, min(d) as whisker_low, max(d) as whisker_high
from flagged join box using (rush_hour)
where d between q25 - 1.5 * (q75 - q25) and q75 + 1.5 * (q75 - q25) group by rush_hour, n, q25, q50, q75"""),
    "weather_impact": over("merged", sql=" union all ".join(f"""
select '{m}' as measure, count(*) as n, {r6(f'regr_slope(dep_delay_s / 60, {m})', 'slope')},
  {r6(f'regr_intercept(dep_delay_s / 60, {m})', 'intercept')}, {r6(f'corr({m}, dep_delay_s / 60)', 'correlation')}
from merged where {m} is not null and dep_delay_s is not null""" for m in IMPACT_WEATHER)),
    "delay_category": over("timed", sql="""
select case when dep_delay_s <= -300 then 'very_early' when dep_delay_s <= -60 then 'early'
  when dep_delay_s <= 60 then 'on_time' when dep_delay_s <= 300 then 'slight_delay'
  when dep_delay_s <= 600 then 'moderate_delay' when dep_delay_s > 600 then 'severe_delay' end as delay_class,
  count(*) as n from timed group by 1"""),
    "regression_metrics": over("timed", sql=f"""
select count(*) as n, {r6('1 - sum(pow(y - p, 2)) / (var_pop(y) * count(*))', 'r2')},
  {r6('sqrt(avg(pow(y - p, 2))) / 60', 'rmse_min')}
from (select dep_delay_s as y, dep_delay_s * 0.5 + l_partkey % 100 as p from timed)"""),
    # journeys
    "journey_distance": over("runs", sql=f"""
select row_key, {r6('leg', 'route_distance')}, {r6('run', 'cumulative_distance')} from runs"""),
    "journey_progress": over("runs", sql=f"""
select row_key, {r6('coalesce(run / nullif(max(run) over (partition by journey_id), 0), 0)', 'journey_progress')}
from runs"""),
    "prev_station_delay": over("legs", sql=f"select row_key, {r6('coalesce(prev, 0)', 'prev_station_delay')} from legs"),
    "delay_trend": over("legs", sql=f"select row_key, {r6('coalesce(dep_delay_s - prev, 0)', 'delay_trend')} from legs"),
    "remaining_stops": over("legs", sql="""
select row_key, cast(seq as int) as station_sequence, cast(stops_total - 1 - seq as int) as remaining_stops from legs"""),
    "historical_pattern": over("timed", sql=f"""
select row_key, {r6("coalesce(avg(dep_delay_s) over (partition by line_id, station_id, "
                    "time_bucket(interval 3 hours, datetime, timestamp '1970-01-01')), 0)", 'historical_delay_pattern')}
from timed"""),
    "severe_weather": over("weather", sql=f"""
select event_id, cast(coalesce(wind_speed > (select quantile_cont(wind_speed, 0.75) from weather), false)
  or coalesce(total_precipitation > (select quantile_cont(total_precipitation, 0.75) from weather), false) as int)
  as severe_weather, {r6('temperature_2m - dewpoint_2m', 'temp_dewpoint_diff')} from weather"""),
    # scalars
    "parse_timestamp": over("stops", sql="""
select row_key, case l_linenumber % 5 when 0 then dep_prog when 1 then date_trunc('minute', dep_prog)
  when 2 then cast(date_trunc('day', dep_prog) as timestamp) when 3 then dep_prog end as ts from stops"""),
    "delay_seconds": over("stops", sql="""
select row_key, date_diff('microsecond', arr_sched, arr_prog) / 1e6 as delay_s,
  date_diff('microsecond', arr_prog, arr_sched) / 1e6 as opposite_s from stops"""),
    "time_features": over("base", sql="""
select row_key, arr_minutes, arr_day_of_week, arr_month, arr_is_weekend,
  dep_minutes, dep_day_of_week, dep_month, dep_is_weekend from base"""),
    "date_components": over("stops", sql=f"""
select row_key, {', '.join(parts(c) for c in ('arr_sched', 'arr_prog', 'dep_sched', 'dep_prog'))},
  dep_prog as dep_prog_ms from stops"""),
    "rush_hour": over("base", sql="""
select row_key, cast(dep_minutes // 60 as int) as hour,
  cast((dep_minutes // 60 between 7 and 9) or (dep_minutes // 60 between 16 and 18) as int) as rush_hour from base"""),
    "synthetic_datetime": over("timed", sql="select row_key, datetime from timed"),
    "journey_id": over("timed", sql="""
select row_key, journey_id as date_line,
  strftime(datetime, '%Y-%m-%d') || '_' || line_id || '_' || (dep_minutes // 60) as date_line_hour,
  strftime(dep_sched, '%Y-%m-%d') || '_' || l_orderkey as trip from timed"""),
    "encode_boolean": over("stops", sql=f"select row_key, {', '.join(FLAGS)} from stops"),
    "encode_categorical": over("stops", sql=f"""
select row_key, {', '.join(code(c) for c in ('line_id', 'line_text', 'station_name'))} from stops"""),
    "encode_all": over("raw", sql="select " + ", ".join(
        code(ours, header) for header, ours in RAW_COLUMNS.items()) + " from raw"),
    # models
    "prepared_full": over("merged", sql="select row_key, " + ", ".join(
        r6(f"coalesce(m.{c}, q.{c}[2])", c) for c in MODEL_WEATHER) + f""",
  coalesce(cast(arr_minutes as double), 0) as arr_minutes, lat from merged m, (select {QUARTILES} from merged) q"""),
    "prepared_compact": over("merged", sql="select row_key, " + ", ".join(
        clipped(c).replace("w.", "m.") for c in MODEL_WEATHER) + f""",
  coalesce(cast(arr_minutes as double), 0) as arr_minutes, lat from merged m, (select {QUARTILES} from merged) q"""),
    "importance_mean": f"select feature, {r6('avg(importance)', 'importance')} from ({IMPORTANCES}) group by feature",
    "importance_topk": f"""select model, feature, {r6('importance')} from ({IMPORTANCES}) where feature in (
  select feature from ({IMPORTANCES}) group by feature order by avg(importance) desc, feature limit 10)""",
    "geo_importance": f"""select model, {r6("sum(case when feature in ('lat', 'lon') then importance else 0 end) * 100", 'geo_pct')}
from ({IMPORTANCES}) group by model""",
    "feature_vector": over("timed", sql=f"""
select row_key, true as in_order, {len(COMPACT_FEATURES)} as width, false as has_null from timed"""),
    # Facts about fitted models that hold whatever the forests look like.
    "feature_importance": "select 1 as complete, 1 as sums_to_one, 0 as negative",
    "model_importances": """select 2 as models, true as geo_in_range, true as complete, true as sums_to_one, 20 as top_rows,
  true as top_above_mean""",
    "permutation_importance": "select 1 as complete, 1 as finite, 1 as ordered",
    "model_roundtrip": over("timed", sql=f"""
select count(*) as n, true as same_scores from timed where {HASH} % 100 < 20"""),
    "predictions": over("timed", sql="select row_key, dep_delay_s, true as predicted from timed"),
    "train_forest": over("timed", sql=f"""
select count(*) as n, true as explains from timed where {HASH} % 100 < 20"""),
    "train_classifier": "select true as better_than_guessing",
    "grid_search": """
select params, true as scored, true as in_order from (values
  ('{"minInstancesPerNode": 5, "minInfoGain": 0.0}'), ('{"minInstancesPerNode": 5, "minInfoGain": 0.1}'),
  ('{"minInstancesPerNode": 10, "minInfoGain": 0.0}'), ('{"minInstancesPerNode": 10, "minInfoGain": 0.1}')) t(params)""",
    "train_test_split": over("stops", sql=f"""
select row_key, case when {HASH} % 100 < 20 then 'test' else 'train' end as part from stops"""),
    "sample_rows": over("stops", sql="select row_key from stops order by md5(row_key), row_key limit 20000"),
    "robust_scale": over("weather", sql="select event_id, " + ", ".join(
        r6(f"(w.{c} - q.{c}[2]) / (q.{c}[3] - q.{c}[1])", c) for c in SCALED)
        + f" from weather w, (select {QUARTILES} from weather) q"),
    "expanding_folds": over("timed", sql=f"""
select datetime, row_key, cast({FOLD_CASES} as int) as fold from (
  select datetime, row_key, row_number() over (order by datetime, row_key) - 1 as p, count(*) over () as n,
    count(*) over () // 4 as t from timed)"""),
}
