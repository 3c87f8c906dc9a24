from __future__ import annotations

import zlib

import numpy as np

from conftest import MEDIUM
from riskflow.llm import language
from riskflow.llm.language import CLASSES, WIDTHS, Network, fit, identify_language, train, windows
from riskflow.llm.queries import queries


def slow_log_probabilities(net, row):
    """The network on one window by its definition: filters over one-hot bytes, maxima, softmax."""
    kept = []
    for w in WIDTHS:
        values = [sum(net.tables[w][j, row[i + j]] for j in range(w)) for i in range(len(row) - w + 1)]
        kept.append(np.max(values, axis=0))
    logits = np.maximum(np.concatenate(kept), 0) @ net.weights + net.bias
    return logits - np.log(np.exp(logits).sum())


def random_network(languages=("xx", "yy", "zz")):
    draw = np.random.default_rng(0)
    tables = {w: draw.normal(size=(w, CLASSES, language.FILTERS)) for w in WIDTHS}
    return Network(languages, tables, draw.normal(size=(len(WIDTHS) * language.FILTERS, 3)), draw.normal(size=3))


def test_network_equals_definition():
    net = random_network()
    x = windows("Ein kurzer Text, ß 123. " * 30)
    for row, fast in zip(x, net.log_probabilities(x)):
        assert np.allclose(slow_log_probabilities(net, row), fast, atol=1e-5)


def test_windows_cover_whole_texts():
    text = "".join(chr(97 + i % 26) for i in range(2000))
    x, step = windows(text), language.WINDOW - max(WIDTHS) + 1
    seen = np.zeros(2000, bool)
    for k, row in enumerate(x):
        for i, c in enumerate(row):
            if k * step + i < 2000:
                assert c == 1 + (k * step + i) % 26
                seen[k * step + i] = True
    assert seen.all()
    assert windows("").shape == windows("abc").shape == (1, language.WINDOW)
    assert len(windows(text, at_most=3)) == 3


def test_long_and_short_texts_in_one_batch_are_judged_alone():
    net = random_network()
    texts = ["abc", "déjà vu " * 9000, None, "123 ...", "zzz"]
    alone = [net.predict([t])[0] for t in texts]
    together = net.predict(texts)
    assert [t[0] for t in together] == [t[0] for t in alone]
    assert np.allclose([t[1] for t in together], [t[1] for t in alone])
    assert together[2] == together[3] == ("und", 0.0)


def test_fit_is_repeatable_and_learns():
    texts = ["the cat and the dog " * 20, "der hund und die katze " * 20] * 40
    x = np.vstack([windows(t)[:1] for t in texts])
    y = np.array([0, 1] * 40)
    a, b = fit(x, y, ("en", "de")), fit(x, y, ("en", "de"))
    assert np.array_equal(a.weights, b.weights)
    assert [p[0] for p in a.predict(["the dog and the cat", "die katze und der hund"])] == ["en", "de"]


def test_query_on_held_out_documents(spark):
    found = queries()["op6_language"](spark, MEDIUM).toPandas().set_index("doc_id")
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet").toPandas().set_index("doc_id")
    assert len(found) == len(docs)
    assert all(found.held_out == [zlib.crc32(str(i).encode()) % 3 == 1 for i in found.index])
    held = found.join(docs)[found.held_out]
    assert (held.lang_pred == held.lang).mean() > 0.97
    assert found.score.between(0, 1).all()


def test_edge_cases(spark):
    data = [(i, t, lang, "z", 0) for i, t, lang in [
        (0, "the cat", "en"), (0, "the cat", "en"), (2, None, "en"), (3, "", None), (4, "12 !?", "en"), (None, "le chat", "fr"),
        (6, "x" * 300_000, None),
    ]]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, lang_pred string, score int")
    found = identify_language(docs, train(docs)).collect()
    assert len(found) == len(data)
    by_id = {r.doc_id: r for r in found}
    assert by_id[2].lang_pred == by_id[3].lang_pred == by_id[4].lang_pred == "und"
    assert by_id[6].lang_pred in ("en", "fr") and by_id[None].held_out is False
    unlearned = identify_language(docs, train(docs.limit(0))).collect()
    assert {r.lang_pred for r in unlearned} == {"und"}
    assert identify_language(docs.limit(0), train(docs)).count() == 0
