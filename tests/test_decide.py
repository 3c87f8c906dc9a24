from __future__ import annotations

import datetime
import random

import pytest
from pyspark.sql import functions as F

from riskflow.operators import decide

START = datetime.datetime(2024, 1, 1)


def moments(n, seed, clients=5, days=20, step=60):
    draw = random.Random(seed)
    return [
        (i, draw.randrange(clients), START + datetime.timedelta(seconds=step * draw.randrange(days * 86400 // step)))
        for i in range(n)
    ]


def test_tiers(rows):
    df = rows([(0.1,), (0.5,), (0.9,)], "score double")
    got = [r[0] for r in df.select(decide.decision(F.col("score"), 0.5, 0.9)).collect()]
    assert got == ["green", "yellow", "red"]


@pytest.mark.parametrize("days, months", [(7, None), (None, 3)])
def test_blacklist_equals_brute_force(rows, days, months):
    tx, listed = moments(300, 1, days=130), moments(8, 2, days=130)
    active = decide.listed_periods(
        rows([(c, t) for _, c, t in listed], "client int, listed_at timestamp"), "client", days=days, months=months
    )
    df = rows(tx, "id int, client int, tx_datetime timestamp")
    hits = {r["id"] for r in decide.blacklisted(df, active, "client").collect()}
    passed = {r["id"] for r in decide.blacklisted(df, active, "client", how="left_anti").collect()}

    def end(day):
        if days:
            return day + datetime.timedelta(days=days)
        year, month = divmod(day.month - 1 + months, 12)
        last = [31, 29, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31][month]
        return datetime.date(day.year + year, month + 1, min(day.day, last))

    expected = {
        i for i, c, t in tx if any(c == lc and lt.date() <= t.date() < end(lt.date()) for _, lc, lt in listed)
    }
    assert hits == expected and 0 < len(hits) < 300
    assert passed == {i for i, _, _ in tx} - expected


def test_blacklist_on_a_stream(spark, rows, tmp_path):
    df = rows(moments(50, 3), "id int, client int, tx_datetime timestamp")
    df.write.parquet(str(tmp_path / "in"))
    active = decide.listed_periods(rows([(1, START)], "client int, listed_at timestamp"), "client")
    stream = decide.blacklisted(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")), active, "client")
    query = stream.writeStream.format("memory").queryName("hits").trigger(availableNow=True).start()
    query.awaitTermination()
    assert set(spark.table("hits").collect()) == set(decide.blacklisted(df, active, "client").collect())


def test_whitelist_overrides(rows):
    df = rows([(1, "a", "red"), (2, "b", "red"), (3, None, "yellow")], "id int, payee string, decision string")
    listed = rows([("a",), ("a",)], "payee string")
    got = {r["id"]: r["decision"] for r in decide.whitelisted(df, listed, "payee").collect()}
    assert got == {1: "green", 2: "red", 3: "yellow"}


def test_average_fraud_amount(rows):
    df = rows([(1, 10.0), (1, 20.0), (0, 99.0)], "tx_fraud int, tx_amount double")
    assert tuple(decide.average_fraud_amount(df).first()) == (2, 15.0)


@pytest.mark.parametrize("hold_days", [1, 3])
def test_fast_credit_holds_equal_brute_force(rows, hold_days):
    asked, issued, tx = moments(3000, 4), moments(3000, 5), moments(400, 6)
    schema = "id int, client int, at timestamp"
    fast = decide.fast_credits(rows(asked, schema), rows(issued, schema), "client")
    spans = [(c, t) for _, c, t in issued if any(c == ac and 60 <= (t - at).total_seconds() <= 300 for _, ac, at in asked)]
    got = sorted((r["client"], r["at"]) for r in fast.collect())
    assert [c for c, _ in got] == [c for c, _ in sorted(spans)] and len(got) > 20
    few = fast.filter("client < 2")
    df = rows(tx, "id int, client int, tx_datetime timestamp")
    held = {r["id"]: r["held"] for r in decide.held_after_fast_credit(df, few, "client", hold_days=hold_days).collect()}
    hold = datetime.timedelta(days=hold_days)
    kept = [(c, t) for c, t in spans if c < 2]
    assert held == {i: any(c == kc and kt < t <= kt + hold for kc, kt in kept) for i, c, t in tx}


def test_service_goals(rows):
    data = [(START, 100.0, 1, 0.0), (START, 10.0, 0, 1.0)] + [(START, 1.0, 0, 0.0)] * 98
    df = rows(data, "tx_datetime timestamp, tx_amount double, tx_fraud int, prediction double")
    got = decide.service_goals(df).first().asDict()
    assert got == {
        "month": "2024-01",
        "n": 100,
        "missed_share": 0.01,
        "false_alarm_share": 0.01,
        "missed_loss": 100.0,
        "missed_ok": True,
        "false_alarm_ok": True,
        "loss_ok": True,
    }
