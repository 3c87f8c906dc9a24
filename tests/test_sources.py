from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from riskflow.fixed_values import RAW_COLUMNS
from riskflow.sources.text import source_date
from riskflow.sources import (
    file_headers,
    kafka_options,
    parse_header,
    parse_lines,
    ragged_rows,
    read_delimited,
    read_header,
    read_kafka_stream,
    read_lines,
    well_formed_rows,
)

HEADER = "#tranaction_id | tx_datetime | a b"


def test_header_names():
    assert parse_header(HEADER) == ["tranaction_id", "tx_datetime", "ab"]


def test_reads_a_day(spark, raw_file):
    parsed, columns = read_delimited(spark, raw_file)
    assert tuple(columns) == RAW_COLUMNS
    assert parsed.count() == 11
    assert ragged_rows(parsed, columns).select("tranaction_id", "n_fields").collect() == [("7", 3)]
    assert well_formed_rows(parsed, columns).count() == 10
    dates = {r[0] for r in parsed.select("source_date").distinct().collect()}
    assert dates == {datetime.date(2020, 1, 2)}


def test_every_header_line_is_dropped_and_quotes_mean_nothing(rows):
    lines = rows([("h",), ('"a,b",c',), ("h",), ("1,2,",), ("",)], "value string")
    parsed = parse_lines(lines, ["x", "y", "z"], "h").collect()
    assert [tuple(r) for r in parsed] == [
        ('"a', 'b"', "c", 3),
        ("1", "2", "", 3),
        ("", None, None, 1),
    ]


def test_delimiter_is_literal(rows):
    lines = rows([("a|b|c",)], "value string")
    assert tuple(parse_lines(lines, ["x", "y", "z"], delimiter="|").first()) == ("a", "b", "c", 3)


def test_many_files_keep_their_names_and_headers(spark, tmp_path):
    for day in ("2020-01-01", "2020-01-02"):
        (tmp_path / f"{day}.txt").write_text("a|b\n1,2\n3,4\n")
    (tmp_path / "2020-01-03.txt").write_text("b|a\n5,6\n")
    headers = {r["source_file"][-14:]: r["header"] for r in file_headers(spark, str(tmp_path)).collect()}
    assert headers == {"2020-01-01.txt": "a|b", "2020-01-02.txt": "a|b", "2020-01-03.txt": "b|a"}
    (tmp_path / "2020-01-00.txt").write_text("")
    (tmp_path / "2020-01-04.txt").write_text("a|c\n7,8\n")
    (tmp_path / "2020-01-05.txt").write_text("a|b|c\n9,10,11\n")
    parsed, columns = read_delimited(spark, f"{tmp_path}/*.txt")
    assert columns == ["a", "b"]
    got = {(str(r["source_date"])[-2:], r["a"], r["b"], r["fits"]) for r in parsed.collect()}
    assert got == {
        ("01", "1", "2", True),
        ("01", "3", "4", True),
        ("02", "1", "2", True),
        ("02", "3", "4", True),
        ("03", "6", "5", True),
        ("04", "7", "8", False),
        ("05", "9", "10", False),
    }


def test_header_comes_from_a_file_start(spark, tmp_path):
    lines = "a|b\n" + "".join(f"{i},{i}\n" for i in range(20_000))
    (tmp_path / "2020-01-01.txt").write_text(lines)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    try:
        assert read_lines(spark, str(tmp_path)).rdd.getNumPartitions() > 1
        assert read_header(spark, str(tmp_path)) == "a|b"
        assert [r["header"] for r in file_headers(spark, str(tmp_path)).collect()] == ["a|b"]
        assert read_delimited(spark, str(tmp_path))[0].count() == 20_000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_no_lines_is_an_error(spark, tmp_path):
    (tmp_path / "empty.txt").write_text("")
    with pytest.raises(ValueError, match="no lines"):
        read_header(spark, str(tmp_path))


def test_split_is_computed_once(spark, raw_file):
    parsed, columns = read_delimited(spark, raw_file)
    filtered = parsed.filter((F.col("terminal_id") != "x") & (F.col("tx_amount") != "y"))
    plan = filtered._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 1


def test_kafka_options():
    options = kafka_options("host:9091", "topic", "group", sasl={"jaas_config": "given"})
    assert options == {
        "kafka.bootstrap.servers": "host:9091",
        "subscribe": "topic",
        "startingOffsets": "earliest",
        "kafka.group.id": "group",
        "kafka.security.protocol": "SASL_SSL",
        "kafka.sasl.mechanism": "SCRAM-SHA-256",
        "kafka.sasl.jaas.config": "given",
    }
    assert "kafka.security.protocol" not in kafka_options("host:9092", "topic")


def test_kafka_needs_its_connector(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        read_kafka_stream(spark, kafka_options("host:9092", "topic"))


@pytest.mark.parametrize(
    "path, date",
    [
        ("file:/data/2020-01-02.txt", "2020-01-02"),
        ("file:/data/2019-01-01/2020-01-02.txt", "2020-01-02"),
        ("file:/data/2020-01-02/part-0.txt", "2020-01-02"),
        ("file:/data/day=2020-01-02/part-0.txt", "2020-01-02"),
        ("file:/data/2019-01-01/x-2020-01-02/y/part-0.txt", "2020-01-02"),
        ("file:/data/2020-13-45.txt", None),
        ("file:/data/part-0.txt", None),
    ],
)
def test_source_date(rows, path, date):
    got = rows([(path,)], "p string").select(source_date(F.col("p"))).first()[0]
    assert (str(got) if got else None) == date
