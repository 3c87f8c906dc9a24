"""Session settings and the shared folder for written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_local_scratch: dict[str, str] = {}
_scopes: list[list[str]] = []


def build_session(app_name: str = "riskflow", master: str | None = None, **conf: object) -> SparkSession:
    """A session with the settings every operator assumes; sizing stays with the caller."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        # Tables partitioned into few folders are written without sorting rows by folder first.
        "spark.sql.maxConcurrentOutputFileWriters": "16",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    settings.update({key: str(value) for key, value in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin_time_zone(spark: SparkSession) -> SparkSession:
    """Hours and timestamps are read in UTC, whatever the machine's zone is."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables and streaming checkpoints.

    A cluster names it in ``spark.checkpoint.dir``. Only a local session without that setting falls
    back to a temporary folder, because executors on other machines could not read one.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith(("local[", "local ")) and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app_id = spark.sparkContext.applicationId
    if app_id not in _local_scratch:
        _local_scratch[app_id] = tempfile.mkdtemp(prefix="riskflow-")
    return _local_scratch[app_id]


def new_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no other run uses; the innermost ``run_scope`` deletes it."""
    path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append(path)
    return path


@contextmanager
def run_scope(spark: SparkSession) -> Iterator[None]:
    """Delete, at the end, the intermediate tables that are made inside.

    For jobs whose results are written elsewhere or are small: nothing that is still to be read may rest on
    these tables.
    """
    _scopes.append([])
    try:
        yield
    finally:
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        for name in _scopes.pop():
            path = hadoop(name)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def small_result(df: DataFrame) -> DataFrame:
    """A result of a few rows, held by the driver, so that it outlives the scope it was computed in."""
    return df.sparkSession.createDataFrame(df.collect(), df.schema)


def materialize(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` once and read it back.

    Several later actions then start from columnar files. A lost executor costs a re-read of those
    files, not a second run of the lineage, and every reader sees the same rows.
    """
    path = new_path(df.sparkSession, name)
    df.write.parquet(path, partitionBy=list(partition_by) or None)
    return df.sparkSession.read.schema(df.schema).parquet(path)
