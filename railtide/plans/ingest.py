"""Raw stop events to the processed table."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from railtide.constants import (
    CATEGORY_COLUMNS, EXCLUDED_COLUMNS, LINE_FILTER, PROCESSED_TYPES,
)
from railtide.functions.times import parse_timestamp, with_delays_and_times
from railtide.operators.clean import cast_columns, filter_in_lists, keep_real
from railtide.operators.encode import category_codes, encode_categories, encode_flags, encoding_table
from railtide.operators.geo import add_coordinates, gazetteer_aliases
from railtide.operators.quality import counted
from railtide.session import leaves_nothing, store
from railtide.sinks.files import write_encodings, write_table, with_source_headers
from railtide.sources.files import filter_months, read_gazetteer, read_stop_csv, recent_months

TIME_COLUMNS = ["arr_sched", "arr_prog", "dep_sched", "dep_prog"]
# Kept next to the processed columns so that journeys and real times stay available.
IDENTITY = ["service_date", "trip_id", "dep_sched", "arr_sched"]


def clean(raw: DataFrame, filters: dict = LINE_FILTER) -> DataFrame:
    """The rows to keep, with parsed times, delays, calendar features and flag codes."""
    df = keep_real(filter_in_lists(raw, filters))
    df = df.withColumns({c: parse_timestamp(F.col(c)) for c in TIME_COLUMNS if c in df.columns})
    if "service_date" in df.columns:
        df = df.withColumn("service_date", F.to_date(parse_timestamp(F.col("service_date"))))
    return encode_flags(with_delays_and_times(df))


def process(cleaned: DataFrame, codes: DataFrame, aliases: DataFrame | None = None) -> DataFrame:
    """Codes and coordinates added, types fixed, everything else dropped."""
    df = encode_categories(cleaned, codes)
    if aliases is not None:
        df = add_coordinates(df, aliases)
    kept = [c for c in [*IDENTITY, *PROCESSED_TYPES] if c in df.columns]
    return cast_columns(df.select(*kept))


@leaves_nothing
def run(spark: SparkSession, raw_path: str | list[str], out: str, gazetteer_path: str | None = None,
        filters: dict = LINE_FILTER, months: int | None = None, as_of: date | None = None,
        source_layout: bool = False) -> dict[str, int]:
    """Read dumps, write ``out/processed`` and ``out/encodings``; returns rows per step.

    ``source_layout`` writes just the 19 processed columns under their German headers. Otherwise
    the table also keeps trip, date and times and is partitioned by month.
    """
    dropped = [c for c in EXCLUDED_COLUMNS if c not in ("service_date", "trip_id")]
    raw = read_stop_csv(spark, raw_path, exclude=dropped)
    if months:
        dated = raw.withColumn("_date", F.to_date(parse_timestamp(F.col("service_date"))))
        raw = filter_months(dated, recent_months(months, as_of or date.today()), "_date").drop("_date")
    aliases = None
    if gazetteer_path:
        aliases = store(gazetteer_aliases(read_gazetteer(spark, gazetteer_path)), "aliases")
    cleaned = clean(raw, filters)
    # Codes need a pass of their own over three columns.
    codes = category_codes(cleaned, CATEGORY_COLUMNS)
    watched, cleaned_rows = counted(cleaned, "cleaned")
    df, written_rows = counted(process(watched, codes, aliases), "written")
    if source_layout:
        write_table(with_source_headers(df.select(*[c for c in PROCESSED_TYPES if c in df.columns])),
                    f"{out}/processed")
    else:
        write_table(df.withColumn("period", F.date_format("service_date", "yyyy-MM")),
                    f"{out}/processed", ["period"])
    write_encodings(encoding_table(codes), f"{out}/encodings")
    return {"cleaned": cleaned_rows.get["rows"], "written": written_rows.get["rows"]}
