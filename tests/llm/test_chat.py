from __future__ import annotations

import itertools

import numpy as np
import pytest

from conftest import MEDIUM
from riskflow.llm import chat
from riskflow.llm.chat import BEGIN, ROLES, Model, format_chat
from riskflow.llm.queries import queries


def random_model():
    draw = np.random.default_rng(3)
    steps = np.log(draw.dirichlet(np.ones(BEGIN), BEGIN + 1))
    shows = {f: np.log(draw.dirichlet(np.ones(n), BEGIN)) for f, n in chat.FEATURES.items()}
    return Model(steps, shows)


def best_path(model, seen):
    def score(path):
        return sum(model.matrix(o)[a, b] for a, b, o in zip((BEGIN, *path), path, seen))

    return list(max(itertools.product(range(BEGIN), repeat=len(seen)), key=score))


def test_path_is_the_most_likely_one():
    draw, model = np.random.default_rng(4), random_model()
    for _ in range(20):
        seen = [tuple(int(draw.integers(n)) for n in chat.FEATURES.values()) for _ in range(6)]
        assert chat._path([model.matrix(o) for o in seen], BEGIN, None) == best_path(model, seen)


@pytest.mark.parametrize("fanout", [2, 3])
def test_runs_of_runs_give_the_same_roles(spark, monkeypatch, fanout):
    data = [(c, t * (1 + c % 2) - 3, "word " * ((c * 7 + t * t) % 40) + "?" * (t % 2)) for c in range(6) for t in range(3 * c + 1)]
    lines = spark.createDataFrame(data, "conv_id long, turn int, text string")
    model = random_model()
    whole = {(r.conv_id, r.turn): r.role for r in format_chat(lines, role_col=None, model=model).collect()}
    monkeypatch.setattr(chat, "FANOUT", fanout)
    found = format_chat(lines, role_col=None, model=model).collect()
    assert {(r.conv_id, r.turn): r.role for r in found} == whole
    assert len(found) == len(data)


def test_query_recovers_held_out_roles(spark):
    found = queries()["op8_chat"](spark, MEDIUM).toPandas()
    given = spark.read.parquet(f"{MEDIUM}/conversations.parquet").toPandas()
    both = found.merge(given, on=["conv_id", "turn"], suffixes=("", "_true"))
    assert len(both) == len(found) == len(given)
    assert (both.given_role == both.role_true).all()
    held = both[both.held_out]
    assert (held.role == held.role_true).mean() > 0.95
    first = both.sort_values(["conv_id", "turn"]).groupby("conv_id").head(1)
    assert first.opens.all()
    opened = both[both.opens]
    assert (opened.rendered == "<|" + opened.role + "|>\n" + opened.text.str.strip(" ") + "\n").all()


def test_markers_decide(spark):
    said = ["System: be brief", "Human: hi", "more of it", "### Assistant: hello", "<|im_start|>user\nso?", "**AI**: yes", "[user] bye"]
    lines = spark.createDataFrame([(1, i, t) for i, t in enumerate(said)], "conv_id long, turn int, text string")
    even = Model(np.log(np.full((BEGIN + 1, BEGIN), 1 / 3)), {})
    counts = {f: np.zeros((BEGIN, n)) for f, n in chat.FEATURES.items()}
    counts["marker"] = np.log(np.full((BEGIN, BEGIN + 1), 0.01) + np.eye(BEGIN, BEGIN + 1) * 0.96)
    steps = even.steps.copy()
    steps[1, 1] += 1  # a user goes on
    rows = sorted(format_chat(lines, role_col=None, model=Model(steps, counts)).collect(), key=lambda r: r.turn)
    assert [r.role for r in rows] == ["system", "user", "user", "assistant", "user", "assistant", "user"]
    assert [r.opens for r in rows] == [True, True, False, True, True, True, True]
    assert "".join(r.rendered for r in rows) == (
        "<|system|>\nbe brief\n<|user|>\nhi\nmore of it\n<|assistant|>\nhello\n<|user|>\nso?\n<|assistant|>\nyes\n<|user|>\nbye\n"
    )


def test_edge_cases(spark):
    data = [(1, 0, "user", None), (1, 0, "user", None), (None, 1, "user", "a"), (2, None, None, "b"), (3, 5, "odd", "x" * 200_000)]
    lines = spark.createDataFrame([(*r, 0, "z") for r in data], "conv_id long, turn int, role string, text string, run int, marker string")
    rows = format_chat(lines).collect()
    assert len(rows) == 5 and {r.role for r in rows} <= set(ROLES)
    assert all(r.opens for r in rows if r.conv_id != 1)
    assert format_chat(lines.limit(0)).count() == 0


def test_transcripts_in_one_text_are_cut_at_their_speakers(spark):
    texts = ["User: hi\nmore\nAssistant: hello\n  User: bye", "Assistant: done", "plain\ntext: none"]
    lines = spark.createDataFrame([(1, i, t) for i, t in enumerate(texts)], "conv_id long, turn int, text string")
    counts = {f: np.zeros((BEGIN, n)) for f, n in chat.FEATURES.items()}
    counts["marker"] = np.log(np.full((BEGIN, BEGIN + 1), 0.01) + np.eye(BEGIN, BEGIN + 1) * 0.96)
    model = Model(np.log(np.full((BEGIN + 1, BEGIN), 1 / 3)), counts)
    rows = sorted(format_chat(lines, role_col=None, model=model).collect(), key=lambda r: (r.turn, r.part))
    assert [(r.turn, r.part) for r in rows] == [(0, 0), (0, 1), (0, 2), (1, 0), (2, 0)]
    assert [r.role for r in rows[:4]] == ["user", "assistant", "user", "assistant"]
    assert "".join(r.rendered for r in rows[:4]) == (
        "<|user|>\nhi\nmore\n<|assistant|>\nhello\n<|user|>\nbye\n<|assistant|>\ndone\n"
    )


@pytest.mark.parametrize("kinds", ["conv_id smallint, turn tinyint", "conv_id string, turn decimal(9,2)", "conv_id date, turn long"])
def test_keys_of_any_type(spark, kinds):
    lines = spark.range(6).selectExpr("CAST(id % 2 AS int) AS c", "id AS t", "'User: x' AS text", "'user' AS role")
    c, t = kinds.split(", ")
    cast = f"date_add(DATE'2024-01-01', c) AS conv_id" if "date" in c else f"CAST(c AS {c.split()[1]}) AS conv_id"
    typed = lines.selectExpr(cast, f"CAST(t AS {t.split()[1]}) AS turn", "text", "role")
    found = format_chat(typed)
    assert found.schema["conv_id"].dataType == typed.schema["conv_id"].dataType
    assert found.schema["turn"].dataType == typed.schema["turn"].dataType
    assert found.count() == 6


def test_a_hot_turn_is_many_runs(spark, monkeypatch):
    monkeypatch.setattr(chat, "FANOUT", 8)
    data = [(1, 5, f"User: {i}") for i in range(100)] + [(1, 5, "User: same")] * 100 + [(2, 1, "Assistant: x")]
    lines = spark.createDataFrame(data, "conv_id long, turn int, text string")
    _, places = chat.observed_lines(lines, role_col=None)
    assert places.groupBy("conv", "run").count().agg({"count": "max"}).head()[0] <= 8
    found = format_chat(lines, role_col=None, model=random_model()).collect()
    assert len(found) == len(data) and sum(r.turn == 5 for r in found) == 200
