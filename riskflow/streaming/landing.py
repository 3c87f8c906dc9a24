"""Incremental landing: each new text file is parsed once and kept as Parquet by date.

``land_files`` reads every file by its own header. ``land_lines`` is for files without headers, whose columns are
known and the same. The checkpoint remembers which files are done; for files that change under the same name
see ``sync_files``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from riskflow.session import materialize
from riskflow.sinks.versions import hadoop_path, publish, read_version
from riskflow.sources.text import list_files, parse_header, parse_lines, read_dated_lines, source_date, with_source_date
from riskflow.streaming.batches import start_batches
from riskflow.streaming.queries import start_table

# Layout of Spark's listing of files.
FILES = "path string, modificationTime timestamp, length bigint, content binary"
VERSIONS = "path string, modified timestamp, length bigint"
NO_DATE = "__HIVE_DEFAULT_PARTITION__"


def stream_lines(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Lines of files as they appear, with the file each comes from."""
    reader = spark.readStream.format("text").option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path).select("value", F.col("_metadata.file_path").alias("source_file"))


def stream_files(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """(path, modified, length) of files as they appear; their content is not read."""
    reader = spark.readStream.format("binaryFile").schema(FILES).option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path).select("path", F.col("modificationTime").alias("modified"), "length")


def land_lines(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    columns: Sequence[str],
    header: str | None = None,
    trigger: dict | None = None,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Parse new files of lines with the given columns and append them, partitioned by the date in their path.

    Lines equal to ``header`` are dropped wherever they stand; headers that say something else are not
    looked at. A task reads pieces of few files and a file holds one day, so a task writes few partitions and rows
    need no shuffle before the write. ``max_files_per_trigger`` keeps the first start over a full folder from
    being one batch of everything.
    """
    parsed = parse_lines(stream_lines(spark, source, max_files_per_trigger), columns, header, keep=("source_file",))
    dated = parsed.transform(with_source_date).drop("source_file")
    return start_table(dated, target, checkpoint, partition_by=("source_date",), trigger=trigger)


def _parsed_files(spark: SparkSession, paths: Sequence[str], header: str) -> DataFrame:
    lines, _ = read_dated_lines(spark, list(paths), header)
    return parse_lines(lines, parse_header(header), keep=("fits", "source_date"))


def land_files(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    header: str,
    trigger: dict | None = None,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Land new files by the header of each: columns in another order come right, other columns do not fit.

    The stream carries the names of new files. A batch reads the first line of each of its files, then the lines
    themselves, and replaces the folder of its id. Rows have the columns of ``header``, n_fields, fits and source_date;
    ``read_batches`` reads them. Files without a line land nothing.
    """

    def land(batch: DataFrame, batch_id: int) -> DataFrame | None:
        # One name per new file, as many as a trigger takes: Spark's own listing holds them on the driver too.
        paths = sorted(r.path for r in batch.filter("length > 0").select("path").collect())
        return _parsed_files(batch.sparkSession, paths, header) if paths else None

    files = stream_files(spark, source, max_files_per_trigger)
    return start_batches(files, land, target, checkpoint, ("source_date",), trigger)


def sync_files(spark: SparkSession, source: str, target: str, seen: str, header: str) -> list[str]:
    """Bring the landed dates up to date with their files, and return the dates that had to be read.

    ``seen`` holds a table of file versions (path, time, length), as of the last run. A date is read again, and
    its partition replaced, if one of its files is new, changed or gone; a date without rows any more goes. Files
    of other dates are not opened. A file without a byte counts as gone. The versions are noted last, so a run that was cut short is simply repeated.
    """
    now = materialize(list_files(spark, source), "files")
    before = read_version(spark, seen, schema=VERSIONS)
    joined = now.alias("now").join(before.alias("before"), "path", "full")
    same = F.col("now.modified").eqNullSafe(F.col("before.modified")) & F.col("now.length").eqNullSafe(
        F.col("before.length")
    )
    date = source_date(F.col("path")).cast("string").alias("date")
    dates = materialize(joined.filter(~same).select(date).distinct(), "dates")
    stale = sorted((r.date for r in dates.collect()), key=str)
    due = now.select("path", "length", date).join(dates.withColumnRenamed("date", "due"), F.col("date").eqNullSafe(F.col("due")))
    files = due.filter("length > 0").select("path").collect()
    full = set()
    if files:
        rows = materialize(_parsed_files(spark, sorted(r.path for r in files), header), "changed")
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("source_date").parquet(target)
        full = {r[0] for r in rows.select(F.col("source_date").cast("string")).distinct().collect()}
    for gone in set(stale) - full:
        system, folder = hadoop_path(spark, f"{target}/source_date={gone or NO_DATE}")
        system.delete(folder, True)
    if stale:
        publish(now, seen, files=1)
    return stale
