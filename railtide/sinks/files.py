"""Writers, and reading back what they wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from railtide.constants import PROCESSED_HEADERS
from railtide.operators.quality import describe_columns, footer_facts, table_files


def write_table(df: DataFrame, path: str, partition_by: list[str] = (), files: int | None = None,
                mode: str = "errorifexists") -> None:
    """Snappy Parquet. Files are sized at run time unless their number is given."""
    out = df.repartition(files) if files else df.hint("rebalance", *partition_by)
    out.write.mode(mode).option("compression", "snappy").partitionBy(*partition_by).parquet(path)


def files_for(gigabytes: float) -> int:
    """Two files per GB of input, at least one."""
    return max(1, int(gigabytes * 2))


def write_chunks(df: DataFrame, path: str, rows_per_file: int = 10_000, rows_per_group: int = 1_000,
                 mode: str = "errorifexists") -> None:
    """Parquet with a fixed number of rows per file and row group, for readers that need small ones."""
    (df.write.mode(mode).option("compression", "snappy")
     .option("maxRecordsPerFile", rows_per_file)
     .option("parquet.block.row.count.limit", rows_per_group)
     .parquet(path))


def write_csv(df: DataFrame, path: str, order: list[str] = (), one_file: bool = False,
              mode: str = "errorifexists") -> None:
    """CSV with header. ``one_file`` is for tables of dimension size."""
    if one_file:
        # A shuffle of its own, so that only the writing takes place in one task.
        out = df.repartition(1)
        out = out.sortWithinPartitions(*order) if order else out
    else:
        out = df.orderBy(*order) if order else df
    out.write.mode(mode).option("header", True).csv(path)


def write_summary(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """A small summary table as JSON lines."""
    df.repartition(1).write.mode(mode).option("ignoreNullFields", False).json(path)


def write_encodings(codes: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """The code table as Parquet, and as text sorted by column and code."""
    codes.write.mode(mode).parquet(f"{path}/table")
    line = F.concat_ws(" ", "column", F.lit(":"), "value", F.lit("->"), "code")
    codes.orderBy("column", "code", "value").select(line.alias("value")).write.mode(mode).text(f"{path}/text")


def read_encodings(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/table")


def with_source_headers(df: DataFrame) -> DataFrame:
    """The processed table under its original German headers."""
    return df.withColumnsRenamed({k: v for k, v in PROCESSED_HEADERS.items() if k in df.columns})


# Holds an empty file per finished version; hidden from readers of the table.
COMMITTED = "_committed"


def _path(spark: SparkSession, name: str):
    """A path and its file system."""
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def write_version(df: DataFrame, root: str, version: str) -> None:
    """A new version next to the old ones, which stay as they are and serve as backup.

    The version is committed by a marker after all of its data is there, and readers see committed versions only. What
    an interrupted run left of a version is written again; a committed version is never touched.
    """
    spark = df.sparkSession
    if version in versions(spark, root):
        raise FileExistsError(f"version {version} of {root} is committed already")
    df.drop("version").write.mode("overwrite").option("compression", "snappy").parquet(f"{root}/version={version}")
    marker, files = _path(spark, f"{root}/{COMMITTED}/{version}")
    # Fails if another run has committed the same version meanwhile.
    files.create(marker, False).close()


def read_version(spark: SparkSession, root: str, version: str | None = None) -> DataFrame:
    """A committed version of a table, by default the latest one by name. Only its folder is read."""
    known = versions(spark, root)
    if not known or version is not None and version not in known:
        raise FileNotFoundError(f"{root} has no committed version{'' if version is None else ' ' + version}")
    return spark.read.parquet(f"{root}/version={version or max(known)}")


def versions(spark: SparkSession, root: str) -> list[str]:
    """Committed versions of a table, by name."""
    path, files = _path(spark, f"{root}/{COMMITTED}")
    return sorted(entry.getPath().getName() for entry in files.listStatus(path)) if files.exists(path) else []


def read_back(spark: SparkSession, path: str, columns: list[str]):
    """Files behind a written table and rows, as its footers tell, and the description of some of its columns."""
    df = spark.read.parquet(path)
    files = table_files(spark, path).withColumn("rows", F.lit(footer_facts(spark, path, [])["rows"]))
    return files, describe_columns(df, [c for c in columns if c in df.columns])
