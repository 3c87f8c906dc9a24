from __future__ import annotations

import math
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from conftest import MEDIUM
from riskflow.llm import toxicity
from riskflow.llm.queries import queries
from riskflow.llm.toxicity import INSULT, THREAT, Model, clause_machine, drop_toxic, fit_logistic, score_toxicity, train, training_rows
from riskflow.llm.transducers import compose, window

PLAIN = Model({w: 3.0 for w in toxicity.SEED_INSULTS}, {"gromp": 3.0}, tuple(toxicity.PRIOR))


def marks(*kinds):
    machine, state, out = clause_machine(), 0, []
    for kind in kinds:
        symbol, _, state = machine.step(state, (kind,))
        out.append(symbol)
    return out


def test_composed_machine_marks_what_stands_in_reach():
    assert marks("target", "", INSULT)[-1] == (INSULT, "targeted")
    assert marks("negation", INSULT)[-1] == (INSULT, "negated")
    assert marks("target", "negation", INSULT)[-1] == (INSULT, "targeted", "negated")
    assert marks("report", "target", "negation", THREAT)[-1] == (THREAT, "targeted", "negated", "reported")
    assert marks("report", "", "", INSULT)[-1] == (INSULT, "reported")
    assert marks("negation", "", "", "", "", "", INSULT)[-1] == (INSULT,)
    assert marks("target", "break", INSULT)[-1] == (INSULT,)


def test_composition_adds_weights():
    first = window("t", "x", "one", 2.0, 2, "b")
    second = window("n", "y", "two", 5.0, 2, "b")
    both = compose(first, second, [("t",), ("n",), ("x",), ("y",), ("b",)])
    state, total = 0, 0.0
    for kind in ("t", "n", "x", "y"):
        _, weight, state = both.step(state, (kind,))
        total += weight
    assert total == 7.0


def test_clauses_not_isolated_words():
    assert PLAIN.features("nothing here") == [0.0] * 6
    hit, denied = PLAIN.features("You are an idiot."), PLAIN.features("You are not an idiot.")
    quoted = PLAIN.features("They said idiot once.")
    assert hit[0] > 0 and hit[1] == 0 and hit[2] > 0
    assert denied[0] == 0 and denied[1] > 0
    assert quoted[0] == 0 and quoted[1] > 0
    assert PLAIN.features("I will kill you")[3] == 0  # the target must come before the threat
    assert PLAIN.features("you I will kill")[3] > 0
    assert PLAIN.features("kill the process")[3] == 0
    assert PLAIN.features("grompings")[0] > 0 and PLAIN.features("agrompings")[0] == 0
    assert PLAIN.features("skidiot idiotic") == [0.0] * 6
    assert PLAIN.score("idiot moron. you stupid scum!") > 0.7 > PLAIN.score("idiot was not said")


def test_a_target_may_follow_its_threat_or_insult():
    for text in ("I will kill you", "we will destroy your family", "ich werde töten dich", "kill all of you"):
        assert PLAIN.evidence(text)[3] > 0, text
    for text in ("kill the process", "I will not kill you", "they said I will kill you", "kill it. you know", "kill a b c d you"):
        assert PLAIN.evidence(text)[3] == 0, text
    assert PLAIN.evidence("you I will kill you") == PLAIN.evidence("you I will kill") == PLAIN.features("you I will kill")
    assert PLAIN.evidence("idiot that you are")[2] > 0 == PLAIN.features("idiot that you are")[2]
    assert PLAIN.evidence("nothing here") == [0.0] * 6
    learned = Model(PLAIN.words, PLAIN.stems, (-1.0, 0.0, 0.0, 0.0, 4.0, 0.0, 0.0))
    assert learned.score("I will kill you") > 0.7 > learned.score("I will kill")


def test_threats_before_their_target_leave_the_pipeline(spark):
    threat, calm = "We will destroy your family. I will kill you.", "I will kill the process."
    data = [(i, threat if i % 4 == 0 else f"{calm} Calm text {i}.") for i in range(400)]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(400)], "doc_id long, toxic int")
    model = Model(PLAIN.words, {}, train(docs, labels).coefficients)  # no learned words: the grammar alone decides
    rows = training_rows(docs, labels).mapInArrow(toxicity._features_of(model), "toxic int, x array<double>").collect()
    fitted = fit_logistic(np.array([r.x for r in rows]), np.array([r.toxic for r in rows], float))
    kept = drop_toxic(docs, Model(PLAIN.words, {}, fitted)).collect()
    assert len(kept) == 300 and all(r.text != threat for r in kept)


def test_logistic_fit_separates():
    x = np.array([[0.0] * 6] * 50 + [[2.0, 0, 0, 0, 1, 2]] * 20)
    y = np.array([0.0] * 50 + [1.0] * 20)
    b = fit_logistic(x, y)
    p = 1 / (1 + np.exp(-(np.hstack([np.ones((70, 1)), x]) @ np.array(b))))
    assert p[:50].max() < 0.2 and p[50:].min() > 0.8 and min(b[1:]) >= 0


def test_query_on_held_out_documents(spark):
    found = queries()["op3_toxicity"](spark, MEDIUM).toPandas().set_index("doc_id")
    assert len(found) == 1000
    assert all(found.held_out == [zlib.crc32(str(i).encode()) % 3 == 1 for i in found.index])
    assert found.score.between(0, 1).all() and (found.predicted == (found.score >= 0.7)).all()
    both = found.join(spark.read.parquet(f"{MEDIUM}/labels.parquet").toPandas().set_index("doc_id"), how="inner")
    held = both[both.held_out]
    assert held[held.toxic == 0].predicted.mean() < 0.02
    assert held[held.toxic == 1].predicted.mean() > 0.5


def test_labels_of_held_out_documents_do_not_matter(spark):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    labels = spark.read.parquet(f"{MEDIUM}/labels.parquet")
    changed = labels.selectExpr(
        "doc_id", "quality", "CASE WHEN crc32(CAST(CAST(doc_id AS string) AS binary)) % 3 = 1 THEN 1 - toxic ELSE toxic END AS toxic"
    )
    assert train(docs, labels) == train(docs, changed)


def test_edge_cases(spark):
    texts = [None, "", "...", "Ünïcode idiot", "idiot moron scum. " * 5000, "fine"]
    data = [(i, t, 1, "x") for i, t in enumerate(texts)] + [(0, None, 1, "x"), (None, "idiot", 1, "x")]
    docs = spark.createDataFrame(data, "doc_id long, text string, score int, toxic string")
    labels = spark.createDataFrame([(None, 1), (1, None), (9, 1)], "doc_id long, toxic int")
    model = train(docs, labels)
    found = score_toxicity(docs, model).collect()
    assert len(found) == len(data)
    by_id = {r.doc_id: r for r in found}
    assert by_id[4].predicted == 1 and by_id[0].predicted == by_id[1].predicted == by_id[5].predicted == 0
    assert not by_id[None].held_out
    kept = drop_toxic(docs, model)
    assert kept.columns == docs.columns and 4 not in {r.doc_id for r in kept.collect()}
    assert score_toxicity(docs.limit(0), train(docs.limit(0), labels.limit(0))).count() == 0


@pytest.mark.parametrize("terms", [({}, {}), ({"a": 2.5}, {"abcd": 3.0})])
def test_weight_takes_the_larger_of_word_and_stem(terms):
    model = Model(*terms, tuple(toxicity.PRIOR))
    assert model.weight("abcdef") == terms[1].get("abcd", 0.0)
    assert model.weight("a") == terms[0].get("a", 0.0)


@pytest.fixture(scope="module")
def trained(spark):
    read = lambda table: spark.read.parquet(f"{MEDIUM}/{table}.parquet")
    return train(read("documents"), read("labels"))


CLEAR = (
    "I will kill you", "I will kill your whole family tomorrow", "We are killing you all", "He kills you", "they murdered your dog",
    "SHOOT YOU", "we will be smashing your face", "ich werde dich töten", "Wir vernichten euch", "er tötet dich", "ich ermorde deine Familie",
    "je vais te tuer", "nous tuerons ta famille", "il vous massacrera", "te voy a matar", "voy a matarte", "te mataremos", "los asesinará usted",
)
HARMLESS = (
    "I will not kill you", "nobody said they kill you", "He said he will kill you", "they kill time", "kill the process", "I hurt myself",
    "ich werde dich nicht töten", "er sagte ich werde dich töten", "sie töten die Zeit", "je ne vais pas te tuer", "il a dit je vais te tuer",
    "tuer le temps", "no te voy a matar", "dijo que te va a matar", "matar el tiempo", "kill it. you know", "",
)


@pytest.mark.parametrize("text", CLEAR)
def test_a_clear_threat_decides(trained, text):
    assert trained.score(text) >= 0.7


@pytest.mark.parametrize("text", HARMLESS)
def test_other_sentences_with_those_words_do_not(trained, text):
    assert trained.score(text) < 0.7


def naive(model, text):
    """The features by looking around each word of a clause."""
    plain = soft = aimed = threats = matched = best = 0.0
    for clause in re.split(r"[.!?;\n]", text.lower()):
        words, score = re.findall(r"[^\W\d_]+(?:'[^\W\d_]+)?", clause), 0.0
        matches = [toxicity._symbol(w, model.weight(w)) for w in words]
        kinds = [m[0] for m in matches]

        def near(i, kind, before, after=0):
            return kind in kinds[max(0, i - before) : i] or kind in kinds[i + 1 : i + 1 + after]

        for i, word in enumerate(words):
            targeted = "targeted" in matches[i] or near(i, "target", 4, 4)
            negated, reported = near(i, "negation", 4), near(i, "report", 8)
            if kinds[i] == INSULT:
                weight = model.weight(word)
                if negated or reported:
                    soft += weight
                else:
                    plain += weight
                    aimed += targeted
                score += max(weight + targeted - negated - reported, 0.0)
            elif kinds[i] == THREAT and targeted and not negated and not reported:
                threats += 1
                score += 3.0
        matched += score > 0
        best = max(best, score)
    return [math.log1p(x) for x in (plain, soft, aimed, threats, matched, best)]


WORDS = "you kill killing idiot gromping matarte tötet not said dog cat the your . ; killer mate".split()


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(WORDS), max_size=40))
def test_grammar_equals_a_naive_matcher(words):
    text = " ".join(words)
    assert PLAIN.evidence(text) == pytest.approx(naive(PLAIN, text))


def test_a_threat_decides_whatever_was_fitted():
    for intercept in (-1.0, -4.0, -9.0):
        model = Model({}, {}, toxicity.deciding((intercept, 2.0, 0.0, 0.0, 0.5, 0.3, 0.1)))
        assert model.score("I will kill you") == pytest.approx(max(0.75, model.score("I will kill you")))
        assert model.score("calm") == pytest.approx(1 / (1 + math.exp(-intercept)))
