from __future__ import annotations

import itertools
import random

import numpy as np
import pytest
import xxhash

from conftest import SMALL
from riskflow.llm.components import connected_components
from riskflow.llm.queries import queries
from riskflow.llm.simhash import (
    BITS,
    covering_masks,
    drop_near_duplicates,
    fingerprint,
    fingerprint_links,
    near_duplicates,
)


def plain_fingerprint(text):
    fold = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for blank in "\t\n\x0b\x0c\r":
        fold = fold.replace(blank, " ")
    words = [w for w in fold.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def closure(values, near):
    """Smallest index reachable from each index, by brute force."""
    root = list(range(len(values)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(values)), 2):
        if near(values[i], values[j]):
            a, b = sorted((find(i), find(j)))
            root[b] = a
    return [find(i) for i in range(len(values))]


def test_fingerprint_equals_definition():
    for text in (None, "", " \t", "One", "one two", "A b C", "Éa É b\x0bc d", "a b c a b c a b c", "x y z w v"):
        assert fingerprint(text) == plain_fingerprint(text)


def test_masks_cover_every_small_difference():
    masks = covering_masks(range(BITS))
    for size in (1, 2):
        for bits in itertools.combinations(range(BITS), size):
            assert any(not m & sum(1 << b for b in bits) for m in masks)
    for bits in random.Random(1).sample(list(itertools.combinations(range(BITS), 3)), 5000):
        assert any(not m & sum(1 << b for b in bits) for m in masks)
    assert all(30 <= m.bit_count() <= 36 for m in masks)


@pytest.mark.parametrize("bucket_rows", [2000, 5])
def test_links_connect_what_all_links_connect(spark, bucket_rows):
    draw = random.Random(bucket_rows)
    centres = [draw.getrandbits(64) for _ in range(6)]
    values = set(centres)
    for centre in centres:
        for _ in range(60):
            value = centre
            for bit in draw.sample(range(64), draw.randint(1, 4)):
                value ^= 1 << bit
            values.add(value)
    values = sorted(values)
    fps = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v,) for v in values], "fp bigint")
    links = fingerprint_links(fps, bucket_rows=bucket_rows).collect()
    ours = {(a & (2**64 - 1), b & (2**64 - 1)) for a, b in links}
    assert all((a ^ b).bit_count() <= 3 for a, b in ours)
    linked = closure(values, lambda a, b: (a, b) in ours or (b, a) in ours)
    assert linked == closure(values, lambda a, b: (a ^ b).bit_count() <= 3)


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    docs.sort()
    fps = [plain_fingerprint(t) for _, t in docs]
    roots = closure(fps, lambda a, b: (a ^ b).bit_count() <= 3)
    expected = {(d, f"{fp:016x}", docs[r][0]) for (d, _), fp, r in zip(docs, fps, roots)}
    assert {tuple(r) for r in queries()["op10_simhash"](spark, SMALL).collect()} == expected


def test_edge_cases(spark):
    data = [(1, None), (2, ""), (3, " "), (4, "a b c"), (4, "A B C"), (None, "a b c"), (7, "x " * 30000)]
    docs = spark.createDataFrame([(i, t, "z", 0) for i, t in data], "doc_id int, text string, component_id string, fp int")
    found = sorted((r.doc_id or -1, r.component_id) for r in near_duplicates(docs).collect())
    assert found == [(-1, 4), (1, 1), (2, 1), (3, 1), (4, 4), (4, 4), (7, 7)]
    kept = drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 4, 7]
    assert near_duplicates(docs.limit(0)).count() == 0


def test_dropping_tells_components_apart_when_ids_do_not(spark):
    draw = random.Random(6)

    def text():
        return " ".join(f"w{draw.randint(0, 10**6)}" for _ in range(60))

    first, second, third, *others = [text() for _ in range(40)]
    data = [(None, t) for t in others[:20]] + [(5, t) for t in others[20:]]  # no near-duplicates among them
    data += [(None, others[0]), (5, others[20].upper())]  # repeats of a row without an id and of one with it
    data += [(1, first), (2, second), (9, second), (9, third), (1, second.upper())]  # 1 leads both first and second
    docs = spark.createDataFrame([(i, t, "z", 0) for i, t in data], "doc_id int, text string, root string, rows int")
    assert len({fingerprint(t) for _, t in data}) == 40
    kept = drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    found = sorted((r.doc_id or -1, r.text.lower()) for r in kept.collect())
    wanted = [(-1, t) for t in others[:20]] + [(5, t) for t in others[20:]]
    assert found == sorted(wanted + [(1, first), (1, second), (9, third)])


def test_an_id_that_leads_elsewhere_saves_no_second_member(spark):
    alike, other = " ".join("abcdefgh"), "quite another text " * 9
    data = [(1, alike), (2, other), (2, alike), (3, other)]  # 2 leads the others' component only
    docs = spark.createDataFrame(data, "doc_id int, text string")
    assert sorted(map(tuple, drop_near_duplicates(docs).collect())) == [(1, alike), (2, other)]


def test_components_of_a_path_and_a_star(spark):
    n = 300
    path = [(i, i + 1) for i in range(n)] + [(1000, 1000 + i) for i in range(1, 200)] + [(5, 5), (None, 3)]
    random.Random(3).shuffle(path)
    links = spark.createDataFrame(path, "a bigint, b bigint")
    found = dict(map(tuple, connected_components(links).collect()))
    assert found == {**{i: 0 for i in range(n + 1)}, **{1000 + i: 1000 for i in range(200)}}
    assert connected_components(links.limit(0)).count() == 0
    assert np.bitwise_count(np.uint64(7)) == 3
