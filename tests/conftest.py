from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from riskflow.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "riskflow-tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "6g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def rows(spark):
    """Build a frame from tuples and a schema string."""

    def build(data, schema):
        return spark.createDataFrame(data, schema)

    return build


@pytest.fixture()
def raw_file(tmp_path):
    """One day's raw file with a fault per line; see FIXTURES.md."""
    folder = tmp_path / "raw"
    folder.mkdir()
    (folder / "2020-01-02.txt").write_text(
        "#tranaction_id | tx_datetime | customer_id | terminal_id | tx_amount | tx_fraud | tx_fraud_scenario\n"
        "1,2020-01-02 03:04:05,17,42,12.50,0,0\n"
        "1,2020-01-02 03:04:05,17,42,12.50,0,0\n"
        "2,2020-01-02 24:00:00,17,42,0.50,1,2\n"
        "3,,18,0,9.00,0,0\n"
        "4,2020-01-02 05:00:00,0,1000,0,0,0\n"
        "5,2020-01-02 06:00:00,19,abc,NaN,0,0\n"
        "6,2020-01-02 07:00:00,20, 12 ,-3.00,0,0\n"
        "7,2020-01-02 08:00:00,21\n"
        "8,2020-01-02 09:00:00,22,999,NaN,0,0\n"
        "9,2020-01-02 10:00:00,23,1, 7.25 ,1,\n"
        "10,2020-01-02 11:00:00,24, 7 ,3.00,1,1\n"
    )
    return str(folder)
