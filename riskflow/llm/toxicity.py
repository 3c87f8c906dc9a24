"""Toxicity by a weighted finite-state grammar over clauses.

Words have kinds: insult, threat, target, negation, reporting verb. A lexical automaton finds insults and
threats in the text; only clauses with one of them are read further, because no other arc carries weight.
Such a clause is read twice. A target transducer reads it backwards and marks a match whose target follows in
its reach ("I will kill you"). What it marks runs forwards through one machine, composed of a target, a negation
and a reported-speech transducer: each marks a match that follows its trigger in its reach and changes its
weight. A threat counts only towards a target, which stands within ``REACH`` words before or after it or is part of
the word, and then one threat that is neither negated nor reported decides: see ``deciding``.

The insult lexicon (words, and stems for inflected forms) and its weights are learned: the log-odds of a term's document
frequency between toxic and other labelled documents, kept where a likelihood-ratio test is clear. What the
grammar finds per document goes into a logistic model, fitted in numpy. Both are fitted on at most
``MAX_TRAINING_DOCS`` labelled documents, chosen by a hash of their ids; scoring reads every whole text.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property, reduce

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from riskflow.llm.common import bounded_batches, held_out, text_rows, with_value
from riskflow.llm.transducers import Symbol, Transducer, compose, marked_inputs, window
from riskflow.session import materialize

MAX_TRAINING_DOCS = 20_000
MAX_TERMS = 4096
MIN_RATIO_TEST = 20.0  # likelihood-ratio statistic of a term, about p = 1e-5
MIN_LOG_ODDS = 2.0
THRESHOLD = 0.7
THREAT_SCORE = 0.75  # at least, of a text with one threat at a target, neither negated nor reported
STEM_LENGTHS = (4, 5)

# Words of the grammar, and insults known without any label.
SEED_INSULTS = (
    "idiot idiots moron morons stupid loser losers scum worthless pathetic disgusting imbecile "
    "dummkopf abschaum versager imbécile crétin connard ordure idiota imbécil estúpido basura"
).split()
# Verbs of threats: stems with the endings they take, irregular forms whole.
THREAT_STEMS = {
    "kill murder destroy hurt attack shoot behead slaughter butcher beat": "- s ed ing en",
    "stab": "- s bed bing",
    "crush smash": "- es ed ing",
    "strangl tortur chok": "e es ed ing",
    "töt vernicht ermord erschieß erstech erwürg verprügel zerstör verletz umbring abstech abknall": "e en est et st t te ten",
    "tu massacr frapp étrangl écras poignard assassin tortur": "er e es ons ez ent erai eras era erons erez eront ant",
    "détrui abatt": "re s rai ras ra rons rez ront sons sez sent sant",
    "mat asesin golpe apuñal dispar aplast estrangul tortur": "ar o as a amos an aré arás ará aremos arán ando aría",
    "destru": "ir iré irás irá iremos irán yo yes ye yendo",
}
THREATS = frozenset(
    stem + end.strip("-") for stems, ends in THREAT_STEMS.items() for stem in stems.split() for end in ends.split()
)
# The same with the target at their end.
AIMED_THREATS = frozenset(
    stem + end for stem in "mat asesin golpe apuñal aplast estrangul tortur".split() for end in ("arte", "aros", "arles", "arlo")
)
TARGETS = (
    "you your yours yourself dich dir dein deine euch ihr te toi tu vous votre ton ta tú te ti usted ustedes tus"
).split()
NEGATIONS = "not no never without isn't aren't don't nicht kein keine nie ohne pas jamais sans aucun nunca jamás sin ni".split()
REPORTING = (
    "said says say called calls quoted wrote claimed sagte sagt nannte schrieb dit disait appelé écrit dijo dice llamó escribió"
).split()

INSULT, THREAT, TARGET, NEGATION, REPORT, BREAK = "insult", "threat", "target", "negation", "report", "break"
KINDS = {**dict.fromkeys(TARGETS, TARGET), **dict.fromkeys(NEGATIONS, NEGATION), **dict.fromkeys(REPORTING, REPORT)}
REACH = 4
THREAT_WEIGHT = 3.0
FEATURES = ("insults", "softened", "targeted", "threats", "clauses", "best_clause")
# Used where labels do not tell: no labels of one kind, or none at all.
PRIOR = np.array([-4.0, 2.2, 0.4, 0.5, 2.0, 0.0, 0.2])
_CLAUSE_END = re.compile(r"[.!?;\n]")
_WORD = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?")


def _both(trigger: str, mark: str, weight: float, reach: int) -> Transducer:
    """Marks insults and threats alike."""
    machines = [window(trigger, kind, mark, weight, reach, BREAK) for kind in (INSULT, THREAT)]
    return Transducer(reduce(lambda x, y: x | y, [m.arcs for m in machines]), machines[0].default)


def target_machine() -> Transducer:
    """Marks what a target precedes in the order of reading: read backwards, what a target follows."""
    return _both(TARGET, "targeted", 1.0, REACH)


def clause_machine() -> Transducer:
    """Target, negation and reported speech composed into one machine, also for what is already targeted."""
    alphabet: list[Symbol] = [(k,) for k in (INSULT, THREAT, TARGET, NEGATION, REPORT, BREAK)]
    alphabet += [(k, "targeted") for k in (INSULT, THREAT)]
    target = target_machine()
    negation = marked_inputs(_both(NEGATION, "negated", -1.0, REACH), ["targeted"])
    report = _both(REPORT, "reported", -1.0, 2 * REACH)
    seen = ["targeted", "negated"]
    report = marked_inputs(report, seen)
    report.arcs.update(
        {
            (state, (kind, "targeted", "negated")): ((kind, "targeted", "negated", "reported"), w, after)
            for (state, (kind, *marks)), (out, w, after) in list(report.arcs.items())
            if marks == ["negated"]
        }
    )
    return compose(compose(target, negation, alphabet), report, alphabet)


def _symbol(word: str, weight: float) -> Symbol:
    """The kind of a word that has this weight as an insult."""
    if word in AIMED_THREATS:
        return THREAT, "targeted"
    return (INSULT if weight else THREAT if word in THREATS else KINDS.get(word, ""),)


@dataclass(frozen=True)
class Model:
    """Weights of whole words and of stems, and the logistic coefficients with the intercept first."""

    words: dict[str, float]
    stems: dict[str, float]
    coefficients: tuple[float, ...]

    @cached_property
    def _automaton(self):
        found = ahocorasick.Automaton()
        for term in {*self.words, *self.stems, *THREATS, *AIMED_THREATS}:
            found.add_word(term, len(term))
        found.make_automaton()
        return found

    @cached_property
    def _machine(self) -> Transducer:
        return clause_machine()

    @cached_property
    def _backward(self) -> Transducer:
        return target_machine()

    def weight(self, word: str) -> float:
        """The weight of a word as an insult, zero if it is none."""
        stem = max([self.stems.get(word[:n], 0.0) for n in STEM_LENGTHS if len(word) > n], default=0.0)
        return max(self.words.get(word, 0.0), stem)

    def _clauses(self, text: str) -> Iterator[str]:
        """Each clause with an insult or threat in it, once."""
        done = 0
        for end, length in self._automaton.iter(text):
            start = end - length + 1
            if start < done or (start and text[start - 1].isalpha()):
                continue
            left = max(text.rfind(mark, done, start) for mark in ".!?;\n") + 1
            right = _CLAUSE_END.search(text, end + 1)
            done = right.start() if right else len(text)
            yield text[max(left, 0) : done]

    def features(self, text: str | None) -> list[float]:
        """What the grammar finds in a text read forwards only, where a target counts if it comes first."""
        return self._found(text, False)

    def evidence(self, text: str | None) -> list[float]:
        """What the grammar finds in a text read both ways: what is learned from and scored."""
        return self._found(text, True)

    def _followed(self, symbols: list[Symbol]) -> tuple[list[Symbol], list[float]]:
        """The symbols of a clause with marks and weights where a target follows."""
        state, marked, weights = 0, [], []
        for symbol in reversed(symbols):
            out, weight, state = self._backward.step(state, symbol)
            marked.append(out)
            weights.append(weight)
        return marked[::-1], weights[::-1]

    def _found(self, text: str | None, backwards: bool) -> list[float]:
        """The features, damped so that long texts do not count for their length alone."""
        plain = soft = aimed = threats = best = 0.0
        matched = 0
        for clause in self._clauses((text or "").lower()):
            state, score = 0, 0.0
            words = _WORD.findall(clause)
            weights = [self.weight(word) for word in words]
            symbols = [_symbol(word, weight) for word, weight in zip(words, weights)]
            symbols, ahead = self._followed(symbols) if backwards else (symbols, [0.0] * len(symbols))
            for symbol, weight, more in zip(symbols, weights, ahead):
                (kind, *marks), bonus, state = self._machine.step(state, symbol)
                bonus += more
                if kind == INSULT:
                    if "negated" in marks or "reported" in marks:
                        soft += weight
                    else:
                        plain += weight
                        aimed += "targeted" in marks
                    score += max(weight + bonus, 0.0)
                elif kind == THREAT and "targeted" in marks:
                    hard = "negated" not in marks and "reported" not in marks
                    threats += hard
                    score += THREAT_WEIGHT * hard
            matched += score > 0
            best = max(best, score)
        return [math.log1p(x) for x in (plain, soft, aimed, threats, matched, best)]

    def score(self, text: str | None) -> float:
        z = self.coefficients[0] + sum(c * x for c, x in zip(self.coefficients[1:], self.evidence(text)))
        return 1.0 / (1.0 + math.exp(-max(min(z, 50.0), -50.0)))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 50) -> tuple[float, ...]:
    """Newton steps towards the maximum of the likelihood, held near ``PRIOR`` by a ridge.

    Finds may only raise a score, so coefficients below zero are cut and the rest fitted again.
    """
    x = np.hstack([np.ones((len(x), 1)), x])
    free, beta = np.ones(x.shape[1], bool), PRIOR.copy()
    for _ in range(x.shape[1]):
        for _ in range(rounds):
            p = 1.0 / (1.0 + np.exp(-np.clip(x @ beta, -30, 30)))
            slope = x.T @ (y - p) - ridge * (beta - PRIOR)
            curve = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(beta))
            step = np.zeros_like(beta)
            step[free] = np.linalg.solve(curve[np.ix_(free, free)], slope[free])
            beta += np.clip(step, -2, 2)
            if np.abs(step).max() < 1e-6:
                break
        below = free & (beta < 0) & (np.arange(len(beta)) > 0)
        if not below.any():
            break
        beta[below], free = 0.0, free & ~below
    return tuple(float(b) for b in beta)


def deciding(coefficients: tuple[float, ...]) -> tuple[float, ...]:
    """The coefficients with one threat at a target scoring ``THREAT_SCORE`` at least.

    Labels may hold few threats or none, and a model fitted on insults alone would pass them over. What a threat adds
    is therefore no less than a rule says, however far the intercept lies below.
    """
    found = dict(zip(FEATURES, coefficients[1:]))
    one = {"threats": math.log1p(1), "clauses": math.log1p(1), "best_clause": math.log1p(THREAT_WEIGHT)}
    others = coefficients[0] + sum(found[name] * x for name, x in one.items() if name != "threats")
    needed = (math.log(THREAT_SCORE / (1 - THREAT_SCORE)) - others) / one["threats"]
    found["threats"] = max(found["threats"], needed)
    return coefficients[0], *found.values()


def _terms(text: Column) -> Column:
    words = F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(r"(\p{L}+)"), F.lit(1)))
    stems = [
        F.transform(F.filter(words, lambda w: F.length(w) > n), lambda w: F.concat(F.substring(w, 1, n), F.lit("*")))
        for n in STEM_LENGTHS
    ]
    return F.concat(words, *[F.array_distinct(s) for s in stems])


def training_rows(docs: DataFrame, labels: DataFrame, max_docs: int = MAX_TRAINING_DOCS) -> DataFrame:
    """(text, toxic, like) of labelled documents outside the held-out third, about ``max_docs`` at most.

    A document counts once per label row; documents that are labelled both ways or null are left out. ``like`` is the
    same for copies.
    """
    verdicts = (
        text_rows(labels, "doc_id", "toxic")
        .filter("doc_id IS NOT NULL AND toxic IN (0, 1)")
        .filter(~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("most"))
        .filter("toxic = most")
        .drop("most")
    )
    verdicts = materialize(verdicts, "verdicts")
    share = min(1.0, max_docs / max(1, verdicts.count()))
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(share * 1_000_000)
    texts = text_rows(docs, "doc_id", "text").filter(draw)
    labelled = texts.join(verdicts.filter(draw), "doc_id").select("text", "toxic", _likeness(F.col("text")).alias("like"))
    return materialize(labelled, "training")


def _likeness(text: Column) -> Column:
    """The smallest hash of five words in a row: the same for copies, and nearly always for near copies."""

    def least(words: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(words) - 4, F.lit(1)))
        return F.array_min(F.transform(starts, lambda i: F.xxhash64(F.slice(words, i, 5))))

    return with_value(F.split(F.lower(F.coalesce(text, F.lit(""))), r"\s+"), least)


def learn_terms(training: DataFrame, max_terms: int = MAX_TERMS) -> tuple[dict[str, float], dict[str, float]]:
    """Insult words and stems with their log-odds. At most ``max_terms`` come to the driver.

    Of texts that are copies or near copies of each other one counts per label: else every word of a large group
    would look like a sign of its label.
    """
    training = training.groupBy("toxic", "like").agg(F.min("text").alias("text"))
    n1, n0 = training.agg(F.count_if(F.col("toxic") == 1), F.count_if(F.col("toxic") == 0)).head()
    words = dict.fromkeys(SEED_INSULTS, MIN_LOG_ODDS)
    if not n1 or not n0:
        return words, {}
    share = n1 / (n0 + n1)
    n = F.col("k1") + F.col("k0")
    test = 2 * (
        F.col("k1") * F.log(F.col("k1") / (n * share))
        + F.when(F.col("k0") > 0, F.col("k0") * F.log(F.col("k0") / (n * (1 - share)))).otherwise(0.0)
    )
    odds = F.log((F.col("k1") + 0.5) / (n1 + 1.0)) - F.log((F.col("k0") + 0.5) / (n0 + 1.0))
    counted = (
        training.select("toxic", F.explode(_terms(F.col("text"))).alias("term"))
        .groupBy("term")
        .agg(F.sum("toxic").alias("k1"), F.count_if(F.col("toxic") == 0).alias("k0"))
        .filter("k1 > 0")
        .select("term", odds.alias("odds"), test.alias("test"))
        .filter((F.col("odds") >= MIN_LOG_ODDS) & (F.col("test") >= MIN_RATIO_TEST))
    )
    found = counted.orderBy(F.desc("test"), "term").limit(max_terms).collect()
    stems = {r.term[:-1]: r.odds for r in found if r.term.endswith("*")}
    return words | {r.term: r.odds for r in found if not r.term.endswith("*")}, stems


def _features_of(model: Model) -> Callable:
    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.evidence(t) for t in batch.column("text").to_pylist()]
            lists = pa.array(found, pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column("toxic").cast(pa.int32()), lists], names=["toxic", "x"])

    return compute


def train(docs: DataFrame, labels: DataFrame, max_docs: int = MAX_TRAINING_DOCS) -> Model:
    """Lexicon and coefficients from the labelled documents that are not held out."""
    bounded_batches(docs.sparkSession)
    training = training_rows(docs, labels, max_docs)
    words, stems = learn_terms(training)
    grammar = Model(words, stems, deciding(tuple(float(x) for x in PRIOR)))
    rows = training.mapInArrow(_features_of(grammar), "toxic int, x array<double>").collect()
    if len({r.toxic for r in rows}) < 2:
        return grammar
    x, y = np.array([r.x for r in rows]), np.array([r.toxic for r in rows], float)
    return Model(words, stems, deciding(fit_logistic(x, y)))


def score_toxicity(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, held_out, score, predicted.

    Null, empty and word-free texts find nothing and get the score of the intercept. Repeated rows are scored
    alike. Other columns are ignored, whatever their names.
    """
    bounded_batches(docs.sparkSession)
    source = text_rows(docs, id_col, text_col).select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = pa.array([model.score(t) for t in batch.column("text").to_pylist()], pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), scores], names=["doc_id", "score"])

    id_type = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(compute, f"doc_id {id_type}, score double").select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def drop_toxic(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The documents with a score below the threshold, with all their columns, in one pass without a shuffle."""
    bounded_batches(docs.sparkSession)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text_col)).to_pylist()
            yield batch.filter(pa.array([model.score(t) < threshold for t in texts], pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
