"""Tables in versions: each is written whole and then becomes current by one file that appears.

A version is a folder under ``_versions``, which plain reads of the table's path pass over. It counts once its
marker exists in ``_committed``: a file is created in one step on every file system and object store, so a reader
sees the old version or the new one and never a part. Old versions stay until ``drop_old_versions``, so readers of
them go on undisturbed. A table has one writer at a time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) of any URI that Spark can reach."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def versions(spark: SparkSession, root: str) -> list[int]:
    """The numbers of all complete versions, the oldest first."""
    system, folder = hadoop_path(spark, f"{root}/_committed")
    if not system.exists(folder):
        return []
    return sorted(int(found.getPath().getName()) for found in system.listStatus(folder))


def version_path(root: str, version: int) -> str:
    return f"{root}/_versions/{version:010d}"


def publish(df: DataFrame, root: str, parts: dict[str, DataFrame] | None = None, files: int | None = None) -> int:
    """Write the next version and make it current; ``parts`` are further tables of it, under their names.

    ``files`` bounds the number of files. What a writer has left that failed half-way is overwritten.
    """
    spark = df.sparkSession
    version = max(versions(spark, root), default=0) + 1
    for name, part in {"data": df, **(parts or {})}.items():
        rows = part.coalesce(files) if files else part
        rows.write.mode("overwrite").parquet(f"{version_path(root, version)}/{name}")
    system, marker = hadoop_path(spark, f"{root}/_committed/{version:010d}")
    system.create(marker, False).close()
    return version


def read_version(
    spark: SparkSession, root: str, version: int | None = None, schema: object = None, part: str = "data"
) -> DataFrame:
    """A version, by default the current one; without any, no rows if a schema is given."""
    found = version or max(versions(spark, root), default=None)
    if found is None:
        if schema is None:
            raise ValueError(f"no version of {root}")
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(f"{version_path(root, found)}/{part}")


def drop_old_versions(spark: SparkSession, root: str, keep: Sequence[int] = ()) -> None:
    """Delete all versions but the current one and those to keep: the marker first, then the data."""
    for version in versions(spark, root)[:-1]:
        if version not in keep:
            for path in (f"{root}/_committed/{version:010d}", version_path(root, version)):
                system, target = hadoop_path(spark, path)
                system.delete(target, True)
