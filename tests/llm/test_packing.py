from __future__ import annotations

import itertools
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from conftest import SMALL
from riskflow.llm.bin_completion import Fillings, best_fit_decreasing, lower_bound, pack
from riskflow.llm.packing import Tokens, cut, pack_documents
from riskflow.llm.queries import queries

PATH = public_tokenizers.path("byte_bpe_50k.json")


def optimum(items, capacity):
    best = len(items)

    def place(i, room):
        nonlocal best
        if len(room) >= best:
            return
        if i == len(items):
            best = len(room)
            return
        for r in set(room):
            if r >= items[i]:
                rest = room.copy()
                rest.remove(r)
                place(i + 1, [*rest, r - items[i]])
        place(i + 1, [*room, capacity - items[i]])

    place(0, [])
    return best


def counts_of(items, capacity):
    return [items.count(n) for n in range(capacity + 1)]


@pytest.mark.parametrize("seed", range(60))
def test_small_packings_are_optimal(seed):
    draw = random.Random(seed)
    capacity = draw.choice([10, 20, 50])
    items = sorted((draw.randint(1, capacity) for _ in range(draw.randint(1, 9))), reverse=True)
    bins = pack(counts_of(items, capacity), capacity)
    assert sorted(itertools.chain(*bins), reverse=True) == items
    assert all(sum(b) <= capacity for b in bins)
    assert lower_bound(counts_of(items, capacity), capacity) <= len(bins) == optimum(items, capacity)


def test_search_beats_best_fit():
    counts = [0] * 1025
    draw = random.Random(8192)
    for _ in range(4000):
        counts[draw.randint(1, 700)] += 1
    assert lower_bound(counts, 1024) <= len(pack(counts, 1024)) <= len(best_fit_decreasing(counts, 1024))


def test_fillings_of_three_and_more():
    lengths = [13, 12, 12, 10, 7, 7, 5, 5, 4, 2, 2]
    assert len(best_fit_decreasing(counts_of(lengths, 20), 20)) == 5
    assert len(pack(counts_of(lengths, 20), 20)) == optimum(lengths, 20) == 4


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 20), min_size=10, max_size=14), st.integers(20, 30))
def test_lists_of_ten_and_more_are_packed_optimally(lengths, capacity):
    lengths.sort(reverse=True)
    bins = pack(counts_of(lengths, capacity), capacity)
    assert sorted(n for b in bins for n in b) == sorted(lengths) and max(map(sum, bins)) <= capacity
    assert len(bins) == optimum(lengths, capacity)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 12), min_size=1, max_size=9), st.integers(4, 16))
def test_fillings_are_those_that_no_other_dominates(lengths, room):
    """Every set that fits, against all sets: one dominates another if its members hold the other's in groups."""
    lengths = [n for n in lengths if n <= room]
    every = {tuple(sorted(c, reverse=True)) for k in range(len(lengths) + 1) for c in itertools.combinations(lengths, k)}
    every = {c for c in every if sum(c) <= room}

    def holds(large, small):
        def put(items, rooms):
            return not items or any(
                room >= items[0] and put(items[1:], [*rooms[:i], room - items[0], *rooms[i + 1 :]])
                for i, room in enumerate(rooms)
            )

        return put(list(small), list(large))

    counts = counts_of(lengths, 16)
    found = list(Fillings(counts, sum(1 << n for n in set(lengths)), room))
    assert len(found) == len(set(found)) and set(found) <= every
    for c in every:
        assert any(holds(f, c) for f in found) or not found
    waste = [room - sum(f) for f in found]
    assert waste == sorted(waste)


def test_empty_packing():
    assert pack([0] * 11, 10) == []


def test_cut():
    assert cut(1, 4) == [(0, 1)]
    assert cut(4, 4) == [(0, 4)]
    assert cut(9, 4) == [(0, 1), (1, 4), (5, 4)]


def test_divided_texts_have_the_same_ids():
    tokens = Tokens(PATH)
    texts = [
        "", " ", "a", " a", "a ", "a  b", "a\n b", "it's 'tis 's", "x\0y z", "foo <|endoftext|> bar", "(a) [b] ###\n\n### c",
        "é è  ê", "a  b c", "ñ\n\nx y\n", "don't 'll 'LL I'm", "1 22 333 4,5", "a\tb c\td", "x　y z", "日本 語 x", "🙂 🙂🙂 a",
    ]
    assert tokens.encode(texts) == tokens.whole(texts) == tokens.encode(texts)


def test_query_against_definition(spark):
    rows = queries()["op7_packing"](spark, SMALL).collect()
    tokenizer = Tokenizer.from_file(PATH)
    docs = dict(map(tuple, spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()))
    pieces = defaultdict(list)
    places = defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        places[r.sequence_id].append((r.offset, r.length))
    assert pieces.keys() == docs.keys()
    for doc_id, own in pieces.items():
        own.sort(key=lambda r: r.piece)
        ids = np.array([*tokenizer.encode(docs[doc_id], add_special_tokens=False).ids, 2], "<u4")
        assert [r.piece for r in own] == list(range(len(own)))
        assert all(r.length == 1024 for r in own[1:])
        assert sum(r.length for r in own) == len(ids)
        at = 0
        for r in own:
            assert r.start == at
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
    for own in places.values():
        ends = 0
        for offset, length in sorted(own):
            assert offset == ends
            ends += length
        assert ends <= 1024
    lengths = [r.length for r in rows]
    assert len(places) <= 1.02 * lower_bound(counts_of(lengths, 1024), 1024) + 1


def test_edge_cases(spark):
    data = [(1, None), (1, None), (2, ""), (None, "word"), (4, "long text " * 20000)]
    docs = spark.createDataFrame([(i, t, 0, "z") for i, t in data], "doc_id int, text string, piece int, ids string")
    rows = pack_documents(docs, PATH, window=2).collect()
    empty = [r for r in rows if r.doc_id in (1, 2)]
    assert [(r.length, bytes(r.ids)) for r in empty] == [(1, b"\2\0\0\0")] * 3
    assert sum(r.length for r in rows if r.doc_id == 4) == len(Tokenizer.from_file(PATH).encode(data[4][1]).ids) + 1
    assert pack_documents(docs.limit(0), PATH).count() == 0
