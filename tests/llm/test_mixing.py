from __future__ import annotations

from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings, strategies as st

from conftest import MEDIUM
from riskflow.llm.mixing import BLOCK_DOCS, in_mixed_order, mix_sources, schedule, shares
from riskflow.llm.queries import queries


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.text("abc", min_size=1, max_size=3), st.floats(0.001, 1000), min_size=1, max_size=12))
def test_schedule_stays_within_one_block(weights):
    slots = shares(weights, 200)
    placed = schedule(slots)
    length = sum(slots.values())
    assert length == max(200, 20 * len(weights))
    assert sorted(s for own in placed.values() for s in own) == list(range(length))
    for source, own in placed.items():
        done = Counter(own)
        so_far = 0
        for slot in range(length):
            so_far += done[slot]
            assert abs(so_far - slots[source] * (slot + 1) / length) < 1


def test_shares_follow_weights():
    assert shares({"a": 3, "b": 1, "c": 0, "d": float("nan")}, 400) == {"a": 300, "b": 100}
    assert shares({}, 10) == {}
    assert min(shares({"a": 1e9, "b": 1e-9}, 100).values()) == 1


def check_mix(rows, weights):
    """Every block whole, and the mix within one block of its weights while all sources last."""
    sizes = Counter(r.source for r in rows)
    blocks = defaultdict(list)
    for r in rows:
        blocks[r.source, r.block].append(r)
    for (source, block), own in blocks.items():
        assert sorted(r.place for r in own) == list(range(min(BLOCK_DOCS, sizes[source] - block * BLOCK_DOCS)))
        assert len({r.slot for r in own}) == 1
    slot_of = {own[0].slot: source for (source, _), own in blocks.items()}
    assert len(slot_of) == len(blocks)
    slots = shares(weights)
    length = sum(slots.values())
    last = {s: max(own[0].slot for (x, _), own in blocks.items() if x == s) for s in sizes}
    so_far = Counter()
    for slot in range(min(last.values()) + 1):
        so_far[slot_of[slot]] += 1
        assert all(abs(so_far[s] - slots[s] * (slot + 1) / length) < 1 for s in slots)


def test_query_mixes_whole_table(spark):
    rows = queries()["op5_mixing"](spark, MEDIUM).collect()
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet").select("doc_id", "source").collect()
    assert Counter((r.doc_id, r.source) for r in rows) == Counter(map(tuple, docs))
    sizes = Counter(r.source for r in docs)
    check_mix(rows, {s: n**0.5 for s, n in sizes.items()})


def test_hot_source_and_given_weights(spark):
    data = [(i, "big" if i % 3 else f"s{i % 4}") for i in range(3000)]
    docs = spark.createDataFrame(data, "doc_id long, source string")
    weights = {"big": 1.0, "s0": 1.0, "s1": 2.0, "s2": 4.0, "s3": 1.0}
    rows = mix_sources(docs, weights).collect()
    assert sorted(r.doc_id for r in rows) == list(range(3000))
    check_mix(rows, weights)


def test_order_of_the_mix(spark):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    ordered = in_mixed_order(docs)
    assert ordered.columns == docs.columns
    got = [r.doc_id for r in ordered.collect()]
    want = sorted(mix_sources(docs).collect(), key=lambda r: (r.slot, r.place))
    assert got == [r.doc_id for r in want]


def test_edge_cases(spark):
    data = [(1, "a"), (1, "a"), (2, None), (None, "a"), (None, None), (4, "none")]
    docs = spark.createDataFrame([(i, s, 0, 0) for i, s in data], "doc_id int, source string, slot int, block int")
    rows = mix_sources(docs, {"a": 1.0, None: 3.0}).collect()
    assert Counter((r.doc_id, r.source) for r in rows) == Counter(data)
    assert [r.slot for r in rows if r.source == "none"] == [None]
    assert [r.doc_id for r in in_mixed_order(docs, {"a": 1.0, None: 3.0}).collect()][-1] == 4
    assert mix_sources(docs.limit(0)).count() == 0
    assert mix_sources(docs, {}).count() == 6


@pytest.mark.parametrize("weights", [None, {"a": 1.0}])
def test_empty_order(spark, weights):
    docs = spark.createDataFrame([], "doc_id int, source string")
    assert in_mixed_order(docs, weights).count() == 0


def brute_places(data, weights):
    """The slots and places by walking through the schedule, given each source's documents in their order."""
    slots = shares(weights)
    pattern = schedule(slots)
    out = {}
    for source, ids in data.items():
        for n, i in enumerate(ids):
            block, place = divmod(n, BLOCK_DOCS)
            turn, at = divmod(block, slots[source])
            out[i] = (turn * sum(slots.values()) + pattern[source][at], place)
    return out


def test_places_equal_the_schedule(spark):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet").select("doc_id", "source")
    rows = mix_sources(docs).collect()
    sizes = Counter(r.source for r in rows)
    own = {s: [r.doc_id for r in sorted((r for r in rows if r.source == s), key=lambda r: (r.block, r.place))] for s in sizes}
    places = brute_places(own, {s: n**0.5 for s, n in sizes.items()})
    assert {r.doc_id: (r.slot, r.place) for r in rows} == places


def test_a_third_of_all_rows_without_an_id_or_alike(spark, monkeypatch):
    from riskflow.llm import mixing

    monkeypatch.setattr(mixing, "CROWD", 5)
    monkeypatch.setattr(mixing, "STRETCH", 7)
    data = [(None, f"text {i}", "a") for i in range(300)] + [(7, "same", "a")] * 300 + [(8, f"own {i}", "b") for i in range(50)]
    data += [(100 + i, "t", "a") for i in range(300)]
    docs = spark.createDataFrame(data, "doc_id long, text string, source string")
    for got in (mix_sources(docs, {"a": 2.0, "b": 1.0}).collect(),):
        assert Counter((r.doc_id, r.source) for r in got) == Counter((i, s) for i, _, s in data)
        check_mix(got, {"a": 2.0, "b": 1.0})
    ordered = in_mixed_order(docs, {"a": 2.0, "b": 1.0})
    assert ordered.columns == docs.columns and Counter(map(tuple, ordered.collect())) == Counter(data)


def test_clashing_columns_in_the_order(spark):
    names = "doc_id int, source string, row int, _id int, _print int, slot int, place int, block int"
    docs = spark.createDataFrame([(1, "a", 1, 1, 1, 1, 1, 1), (2, "a", 2, 2, 2, 2, 2, 2)], names)
    assert sorted(map(tuple, in_mixed_order(docs).collect())) == sorted(map(tuple, docs.collect()))


def test_rows_that_differ_by_a_microsecond_both_stay(spark):
    docs = spark.sql(
        "SELECT 1 AS doc_id, 'a' AS source, timestamp_micros(n) AS seen, timestamp_ntz '2024-01-01 00:00:00' AS at"
        " FROM VALUES (1L), (2L), (2L) AS t(n)"
    )
    mixed = in_mixed_order(docs)
    assert sorted(map(tuple, mixed.collect())) == sorted(map(tuple, docs.collect()))


def test_ranges_are_drawn_from_places_not_from_texts(spark):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    plan = in_mixed_order(docs)._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    depth = [len(line) - len(line.lstrip(" :+-")) for line in lines]
    ranges = [i for i, line in enumerate(lines) if "rangepartitioning" in line]
    assert ranges
    for i in ranges:
        end = next((k for k in range(i + 1, len(lines)) if depth[k] <= depth[i]), len(lines))
        assert not any("text#" in line or "row#" in line for line in lines[i:end])
