"""Coverage of the weather match and profiles of written data sets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Observation
from pyspark.sql import functions as F

from railtide.operators.stats import describe_values


def weather_coverage(df: DataFrame, month: str = "dep_month", station: str = "station_id") -> DataFrame:
    """Events with and without weather: overall, per month and per station, from one pass."""
    found = F.count_if("weather_station_found")
    return (
        df.groupingSets([[month], [station], []], month, station)
        .agg(F.grouping_id().alias("_set"), F.count(F.lit(1)).alias("total"), found.alias("with_weather"))
        .select(
            F.when(F.col("_set") == 1, "month").when(F.col("_set") == 2, "station")
            .otherwise("all").alias("level"),
            F.col(month).cast("int").alias("month"),
            F.col(station).cast("int").alias("station_id"),
            "total", "with_weather", (F.col("total") - F.col("with_weather")).alias("missing_weather"),
            (F.col("with_weather") * F.lit(100.0) / F.col("total")).alias("coverage_percentage"))
    )


def stations_without_weather(df: DataFrame, station: str = "station_id") -> DataFrame:
    return df.where(~F.col("weather_station_found")).select(station).distinct()


def time_diff_stats(df: DataFrame) -> DataFrame:
    """Mean, median, largest and smallest distance in time of the matched events."""
    matched = df.where("weather_station_found")
    return describe_values(matched, ["time_diff_minutes"], {0.5: "median"}).select("mean", "median", "max", "min")


def dataset_profile(df: DataFrame) -> DataFrame:
    """One row for the table, and one for each ``_encoded`` column with its distinct codes and range."""
    coded = [c for c in df.columns if c.endswith("_encoded")]
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("bigint").alias("code"))
                      for c in coded], F.struct(F.lit("*").alias("column"), F.lit(None).cast("bigint").alias("code")))
    return (
        df.select(F.inline(pairs)).groupBy("column", "code").agg(F.count(F.lit(1)).alias("n"))
        .groupBy("column").agg(
            F.sum("n").alias("total_rows"), F.count("code").alias("unique_values"),
            F.min("code").alias("min_code"), F.max("code").alias("max_code"))
        .withColumn("columns", F.lit(len(df.columns)))
    )


def counted(df: DataFrame, step: str) -> tuple[DataFrame, Observation]:
    """The table, and its row count as seen by the job that will run it; no job of its own."""
    seen = Observation(step)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def table_files(spark: SparkSession, path: str) -> DataFrame:
    """Number of data files of a table and their size, from the listing alone."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = folder.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(folder, True)
    files = size = 0
    while found.hasNext():
        entry = found.next()
        # Hidden files are not part of the table.
        if not any(part.startswith(("_", ".")) for part in entry.getPath().toString()[len(folder.toString()):].split("/")):
            files, size = files + 1, size + entry.getLen()
    return spark.createDataFrame([(files, size)], "files long, bytes long")


def footer_table(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """One row: rows of a Parquet table, and non-null values, least and greatest of each column, by number. Tasks read them
    from the footers; no data is scanned. For numbers, dates and flags."""
    reader = spark.newSession()
    # The reader that takes aggregates from footers, in a session of its own.
    reader.conf.set("spark.sql.sources.useV1SourceList", "")
    reader.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    facts = [f(c).alias(f"{name}{i}") for i, c in enumerate(columns) for name, f in (("count", F.count), ("min", F.min), ("max", F.max))]
    return reader.read.parquet(path).agg(F.count(F.lit(1)).alias("rows"), *facts)


def footer_facts(spark: SparkSession, path: str, columns: list[str]) -> dict:
    """``rows``, and (non-null values, least, greatest) of every column."""
    row = footer_table(spark, path, columns).first()
    return {"rows": row["rows"]} | {c: (row[f"count{i}"], row[f"min{i}"], row[f"max{i}"]) for i, c in enumerate(columns)}


def written_profile(spark: SparkSession, path: str) -> DataFrame:
    """The profile of ``dataset_profile`` for a Parquet table: rows and ranges from its footers, and
    a scan of the ``_encoded`` columns alone for the number of their codes."""
    df = spark.read.parquet(path)
    coded = [c for c in df.columns if c.endswith("_encoded")]
    facts = footer_facts(spark, path, coded)
    rows = [("*", facts["rows"], None, None), *[(c, facts["rows"], *facts[c][1:]) for c in coded]]
    known = spark.createDataFrame(rows, "column string, total_rows long, min_code long, max_code long")
    names = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("bigint").alias("code")) for c in coded])
    codes = df.select(F.inline(names)).groupBy("column", "code").agg(F.lit(1)).groupBy("column").agg(
        F.count("code").alias("unique_values")) if coded else spark.createDataFrame([], "column string, unique_values long")
    # One row per encoded column on both sides.
    return known.join(codes, "column", "left").select(
        "column", "total_rows", F.coalesce("unique_values", F.lit(0)).cast("long").alias("unique_values"), "min_code", "max_code",
        F.lit(len(df.columns)).alias("columns"))


def describe_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows, non-null values, mean, deviation and range of each column, one row per column."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v")) for c in columns])
    return df.select(F.inline(pairs)).groupBy("column").agg(
        F.count(F.lit(1)).alias("rows"), F.count("v").alias("non_missing"),
        F.avg("v").alias("mean"), F.stddev_samp("v").alias("std"),
        F.min("v").alias("min"), F.max("v").alias("max"))
