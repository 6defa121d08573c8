"""Session settings and the shared scratch folder."""

from __future__ import annotations

import functools
import re
import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, app: str = "railtide", **options: str) -> SparkSession:
    """A session with our defaults; ``options`` override them, keys written with ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = DEFAULTS | {k.replace("__", "."): v for k, v in options.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


# Folders of local sessions without ``spark.checkpoint.dir``, one per application.
_LOCAL_FOLDERS: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    A session in one process (``local`` or ``local[n]``) may leave it unset and gets one folder for
    the application; any cluster, ``local-cluster`` included, is refused without the setting.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rsplit("/", 1)[0]
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    application = spark.sparkContext.applicationId
    if application not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[application] = tempfile.mkdtemp(prefix="railtide-")
    return _LOCAL_FOLDERS[application]


# Folders of the plans that are running, the innermost last.
_PLANS: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder, or below the folder of the running plan."""
    root = _PLANS[-1] if _PLANS else f"{shared_dir(spark).rstrip('/')}/railtide"
    return f"{root}/{name}-{uuid.uuid4().hex}"


def leaves_nothing(plan):
    """Run a plan, whose first argument is the session, with a folder for its intermediate tables
    that is removed when it ends. What it returns must not read them."""
    @functools.wraps(plan)
    def run(spark: SparkSession, *args, **options):
        folder = scratch_path(spark, plan.__module__.rsplit(".", 1)[-1])
        _PLANS.append(folder)
        try:
            return plan(spark, *args, **options)
        finally:
            _PLANS.pop()
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return run


# Spark's setting for shuffle files to go when the query that wrote them ends, and who has it on now.
_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_FREEING: dict = {"depth": 0, "before": None}
_FREEING_LOCK = threading.Lock()


@contextmanager
def shuffles_freed(spark: SparkSession):
    """Queries that run inside drop their shuffle files when they end, not when the driver happens to
    collect its garbage. For tables that are written and read back, which need them no more."""
    with _FREEING_LOCK:
        if not _FREEING["depth"]:
            _FREEING["before"] = spark.conf.get(_FREE_SHUFFLES, None)
            spark.conf.set(_FREE_SHUFFLES, "true")
        _FREEING["depth"] += 1
    try:
        yield
    finally:
        with _FREEING_LOCK:
            _FREEING["depth"] -= 1
            if not _FREEING["depth"]:
                before = _FREEING["before"]
                spark.conf.unset(_FREE_SHUFFLES) if before is None else spark.conf.set(_FREE_SHUFFLES, before)


def store(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write the table to the shared folder and read it back.

    Cuts lineage so that a lost executor cannot change the rows, and later steps scan only the
    columns they need instead of computing the table again. What it was shuffled by goes at once.
    """
    path = scratch_path(df.sparkSession, name)
    with shuffles_freed(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def forget(*stored: DataFrame) -> None:
    """Remove stored tables that nothing reads any more."""
    for df in stored:
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)
