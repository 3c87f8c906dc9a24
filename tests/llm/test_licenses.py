from __future__ import annotations

import random
from importlib import resources

from conftest import MEDIUM
from riskflow.llm import licenses
from riskflow.llm.license_texts import BODIES, TEMPLATES
from riskflow.llm.licenses import BANDS, CONTAINMENT, ROWS, SHINGLE, Scanner, scan_licenses, words_of
from riskflow.llm.queries import queries

SCANNER = Scanner()


def contained(text):
    """Brute force: the best share of each template's shingles within any stretch a quarter longer than it."""
    words = words_of(text)
    found = {}
    for name, template in TEMPLATES.items():
        wanted_words = words_of(template)
        wanted = set(zip(*(wanted_words[i:] for i in range(SHINGLE))))
        reach = len(wanted_words) + 2 * int(licenses.SLACK * len(wanted_words))
        shingles = list(zip(*(words[i:] for i in range(SHINGLE))))
        best = max(
            (len(wanted & set(shingles[i : i + reach - SHINGLE + 1])) / len(wanted) for i in range(max(1, len(shingles)))),
            default=0,
        )
        if best >= CONTAINMENT:
            found[name] = best
    return found


def test_query_finds_what_brute_force_finds(spark):
    got = {}
    for r in queries()["op4_licenses"](spark, MEDIUM).collect():
        got.setdefault(r.doc_id, set()).add((r.license_id, r.template))
    for doc_id, text in map(tuple, spark.read.parquet(f"{MEDIUM}/documents.parquet").select("doc_id", "text").collect()):
        if "icense" in text or doc_id in got:
            assert got.get(doc_id, set()) == set(contained(text)), doc_id


def test_each_template_in_noise_and_across_lines():
    draw = random.Random(5)
    for name, text in TEMPLATES.items():
        noise = [f"w{draw.randint(0, 999)}" for _ in range(draw.randint(0, 300))]
        at = draw.randint(0, len(noise))
        whole = " ".join([*noise[:at], text.replace(" ", "\n", 3).upper(), *noise[at:]])
        (match,) = [m for m in SCANNER.scan([whole])[0] if (m.license_id, m.template) == name]
        assert match.containment == 1.0 and match.start_word == at
        assert match.end_word == at + len(words_of(text))


def test_edited_copies_decide_by_containment():
    draw = random.Random(8)
    for name, text in TEMPLATES.items():
        words = text.split()
        if len(words) < 20:
            continue
        for _ in range(5):
            edited = words.copy()
            for i in draw.sample(range(len(words)), draw.randint(0, 2)):
                edited[i] = "changed"
            whole = "before " * 7 + " ".join(edited) + " after" * 9
            names = {(m.license_id, m.template) for m in SCANNER.scan([whole])[0]}
            assert (name in names) == (name in contained(whole))


def ids(text):
    return {m.license_id for m in SCANNER.scan([text])[0]}


def test_bodies_versions_and_variants():
    for license_id, file in BODIES.items():
        body = (resources.files("riskflow.llm") / "license_bodies" / f"{file}.txt").read_text("utf-8")
        middle = " ".join(body.split()[len(body.split()) // 3 :][:300])
        assert any(license_id in found.split(" or ") for found in ids(middle)), license_id
    assert ids("This work is licensed under the GNU General Public License, version 2.") == {"GPL-2.0"}
    assert ids("This work is licensed under the GNU General Public License, version 3.") == {"GPL-3.0"}
    assert ids("This work is licensed under the GNU General Public License, version 9.") == set()
    for kind in ("BY", "BY-SA", "BY-ND", "BY-NC", "BY-NC-SA", "BY-NC-ND"):
        assert ids(f"x Licensed under CC {kind} 4.0. y") == {f"CC-{kind}-4.0"}
    assert ids(TEMPLATES["MIT", "disclaimer"]) == {"MIT"} and ids(TEMPLATES["Zlib", "grant"]) == {"Zlib"}
    notice = SCANNER.scan([TEMPLATES["Apache-2.0", "notice"]])[0]
    assert [m.template for m in notice] == ["notice"]


def test_band_settings():
    assert 1 - (1 - 0.8**ROWS) ** BANDS > 0.999


def test_texts_in_one_batch_do_not_join():
    first, second = "Licensed under the Apache", "License, Version 2.0."
    assert SCANNER.scan([first, second, None, "", first + " " + second]) [:4] == [[], [], [], []]
    assert len(SCANNER.scan([first, second, first + " " + second])[2]) == 1


def test_edge_cases(spark):
    mit = TEMPLATES["MIT", "short"]
    texts = [None, "", mit, mit + " x " + mit, "pad " * 50000 + mit, "a b c d"]
    data = [(i, t, 0, "z") for i, t in enumerate(texts)] + [(2, mit, 0, "z"), (None, mit, 0, "z")]
    docs = spark.createDataFrame(data, "doc_id int, text string, containment int, passage string")
    rows = scan_licenses(docs).collect()
    assert sorted((r.doc_id if r.doc_id is not None else -1) for r in rows) == [-1, 2, 2, 3, 3, 4]
    assert {r.passage for r in rows} == {mit.rstrip(".")}
    assert scan_licenses(docs.limit(0)).count() == 0
    own = scan_licenses(docs, {("X", "x"): "one two three four five"})
    assert own.count() == 0


def test_many_short_lines_cost_in_proportion():
    import time

    from riskflow.llm.licenses import Scanner

    scanner = Scanner({("X", "line"): "licensed under the terms of the plain example license of this very test"})
    line = "licensed under the terms of the plain example license of this very test\n"
    seconds = []
    for n in (1000, 8000):
        start = time.perf_counter()
        (found,) = scanner.scan([line * n])
        seconds.append(time.perf_counter() - start)
        assert len(found) == n
    assert seconds[1] < 24 * seconds[0]  # eight times as many lines; in proportion to their square it would be 64
