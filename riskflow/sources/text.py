"""Delimited text without quoting, whose header uses another delimiter than its rows.

Lines stay DataFrame rows from the start: splitting, counting fields and naming columns are native
expressions, so a scan of many files is one splittable, generated stage.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from riskflow.fixed_values import FIELD_DELIMITER, HEADER_DELIMITER, HEADER_RENAMES
from riskflow.session import materialize

HEADER_JOBS = 16
DATE_IN_NAME = r"(\d{4}-\d{2}-\d{2})"


def parse_header(
    line: str, delimiter: str = HEADER_DELIMITER, renames: Mapping[str, str] = HEADER_RENAMES
) -> list[str]:
    """Column names of a header line; blanks around and inside names are dropped."""
    names = "".join(line.split()).split(delimiter)
    return [renames.get(name, name) for name in names]


def read_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """All lines with the file they come from. ``path`` may be a list, a folder or a pattern."""
    return spark.read.text(path).select("value", F.col("_metadata.file_path").alias("source_file"))


def read_header(spark: SparkSession, path: str | Sequence[str]) -> str:
    """The first line of the first file by name that has one: one row to the driver."""
    return _first_header(file_headers(spark, path), path)


def _first_header(headers: DataFrame, path: str | Sequence[str]) -> str:
    first = headers.orderBy("source_file").select("header").head(1)
    if not first:
        raise ValueError(f"no lines in {path}")
    return first[0]["header"]


def list_files(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(path, modified, length) of all files that hold anything, without reading them."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return listed.select("path", F.col("modificationTime").alias("modified"), "length")


def first_line(spark: SparkSession, path: str) -> DataFrame:
    """(source_file, header) of one file. Spark stops the scan at a limit, so only the first bytes are read."""
    return spark.read.text(path).select(F.col("_metadata.file_path").alias("source_file"), F.col("value").alias("header")).limit(1)


def file_headers(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """The first line of every file that has one: (source_file, header), stored.

    A job of one task per file, ``HEADER_JOBS`` at a time. The cost grows with the number of files and not with
    their size. The driver holds a name and a line per file, as it holds the listing of them.
    """
    files = [r.path for r in list_files(spark, path).filter("length > 0").select("path").collect()]
    with ThreadPoolExecutor(HEADER_JOBS) as pool:
        found = [row for rows in pool.map(lambda file: first_line(spark, file).collect(), files) for row in rows]
    return materialize(spark.createDataFrame(found, "source_file string, header string"), "headers")


def source_date(path: Column) -> Column:
    """The date a file's name starts with, else its folder's name (also as ``key=date``), else the last
    date spelled in its path, or null.

    The usual names are read by position; a search, which costs more than parsing a line, is the last
    resort.
    """
    name = F.substring_index(path, "/", -1)
    folder = F.substring_index(F.substring_index(F.substring_index(path, "/", -2), "/", 1), "=", -1)
    dates = F.regexp_extract_all(path, F.lit(DATE_IN_NAME), F.lit(1))
    return F.coalesce(
        _exact_date(F.substring(name, 1, 10)),
        _exact_date(F.substring(folder, 1, 10)),
        F.try_element_at(dates, F.lit(-1)).try_cast("date"),
    )


def _exact_date(text: Column) -> Column:
    """The date that is spelled out in full; a cast alone would also take years and other short forms."""
    return F.when(text.rlike(f"^{DATE_IN_NAME}$"), text.try_cast("date"))


def with_source_date(df: DataFrame, file_column: str = "source_file") -> DataFrame:
    return df.withColumn("source_date", source_date(F.col(file_column)))


def _literal(delimiter: str) -> str:
    """A pattern for the delimiter itself. A plain or escaped character is split without a regex engine."""
    return "".join(c if c.isalnum() or c in ",; \t" else f"\\{c}" for c in delimiter)


def parse_lines(
    lines: DataFrame,
    columns: Sequence[str],
    header: str | None = None,
    delimiter: str = FIELD_DELIMITER,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Lines to string columns plus ``n_fields``; every line equal to the header is dropped.

    Short lines get nulls and long ones keep their first fields: ``n_fields`` tells them apart.
    Trailing empty fields count. The split is the output of a generator, so that filters on the columns
    stay above it; below, each would split the line again for every column it names.
    """
    if header is not None:
        lines = lines.filter(F.col("value") != header)
    split = lines.select(*keep, F.explode(F.array(F.split("value", _literal(delimiter)))).alias("fields"))
    return split.select(
        *[F.get("fields", F.lit(i)).alias(name) for i, name in enumerate(columns)],
        F.size("fields").alias("n_fields"),
        *keep,
    )


def well_formed_rows(parsed: DataFrame, columns: Sequence[str]) -> DataFrame:
    return parsed.filter(F.col("n_fields") == len(columns)).drop("n_fields")


def ragged_rows(parsed: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with too few or too many fields."""
    return parsed.filter(F.col("n_fields") != len(columns))


def read_delimited(spark: SparkSession, path: str | Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Read files by their headers: (parsed rows with file, date and ``fits``, column names)."""
    lines, header = read_dated_lines(spark, path)
    columns = parse_header(header)
    return parse_lines(lines, columns, keep=("source_file", "source_date", "fits")), columns


def read_dated_lines(
    spark: SparkSession, path: str | Sequence[str], header: str | None = None
) -> tuple[DataFrame, str]:
    """Lines of files without their headers: (value, source_file, source_date, fits), and the header they follow.

    Every file's own header is read from its first bytes. Lines of a file with the same columns in another order are
    put into the order of ``header``, by default that of the first file; lines of a file with other columns stay
    as they are and do not fit. Lines are joined with the headers only if some differ.
    """
    headers = file_headers(spark, path)
    header = header or _first_header(headers, path)
    lines = read_lines(spark, path)
    others = headers.filter(F.col("header") != header)
    if others.isEmpty():
        lines = lines.filter(F.col("value") != header).withColumn("fits", F.lit(True))
    else:
        lines = _in_order(lines, others, header)
    return lines.transform(with_source_date), header


def _in_order(lines: DataFrame, others: DataFrame, header: str) -> DataFrame:
    """Lines of all files in the order of ``header``; ``others`` are the files with another one."""
    columns = parse_header(header)
    plain = F.split(F.regexp_replace("header", r"\s", ""), _literal(HEADER_DELIMITER))
    names = F.transform(plain, lambda n: F.coalesce(*[F.when(n == a, b) for a, b in HEADER_RENAMES.items()], n))
    places = F.transform(F.array(*map(F.lit, columns)), lambda c: F.array_position(names, c).cast("int"))
    fits = (F.size(names) == len(columns)) & ~F.array_contains(places, 0)
    own = materialize(
        others.select("source_file", F.col("header").alias("own_header"), F.when(fits, places).alias("places")),
        "other-headers",
    )
    joined = lines.join(own, "source_file", "left").filter(F.col("value") != F.coalesce("own_header", F.lit(header)))
    fields = F.split("value", _literal(FIELD_DELIMITER))
    moved = F.concat_ws(FIELD_DELIMITER, F.transform("places", lambda i: F.element_at(fields, i)))
    complete = F.col("places").isNotNull() & (F.size(fields) == len(columns))
    return joined.select(
        F.when(complete, moved).otherwise(F.col("value")).alias("value"),
        "source_file",
        (F.col("own_header").isNull() | F.col("places").isNotNull()).alias("fits"),
    )
