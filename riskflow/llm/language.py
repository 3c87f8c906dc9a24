"""Language identification by a convolutional network over bytes.

Letters A-Z are folded, other ASCII bytes but letters are one class. Filters of several widths run over windows of a
fixed number of bytes, each filter keeps its maximum over a window, and a softmax over the kept values gives
the language of the window. A text's windows cover all of it; its language is that of their mean log
probabilities, weighted by the letters in each.

A filter over one-hot bytes is a sum of table rows, one per offset. Neighbouring offsets are merged into one
table over byte pairs, so a filter of width 2n costs n look-ups per byte. The network is trained in numpy on the
driver, on windows of at most ``MAX_DOCS`` documents per language that tasks cut out; so few bytes arrive there
whatever the size of the texts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from riskflow.llm.common import bounded_batches, held_out, text_rows

WINDOW = 256
WIDTHS = (2, 4, 6)
FILTERS = 16
MAX_DOCS = 1000  # per language
TRAINING_WINDOWS = 6  # per document
UNDETERMINED = "und"
EPOCHS = 4
BATCH = 64
SEED = 7
WINDOWS_AT_ONCE = 128
_LETTER = re.compile(r"[^\W\d_]")

# Byte classes: 0 for ASCII other than letters, 1-26 for letters of either case, then one per other byte.
_CLASS = np.zeros(256, np.uint8)
_CLASS[ord("a") : ord("z") + 1] = _CLASS[ord("A") : ord("Z") + 1] = np.arange(1, 27)
_CLASS[128:] = np.arange(27, 155)
CLASSES = 155


def windows(text: str, size: int = WINDOW, at_most: int | None = None) -> np.ndarray:
    """The windows of a text as rows of byte classes, with an overlap in which no filter loses a position.

    ``at_most`` spreads so many windows evenly over the text. The last window is filled with class 0.
    """
    data = _CLASS[np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)]
    step = size - max(WIDTHS) + 1
    n = max(1, -(-(len(data) - size) // step) + 1)
    chosen = np.arange(n) if at_most is None or n <= at_most else np.linspace(0, n - 1, at_most).astype(int)
    out = np.zeros((len(chosen), size), np.uint8)
    for row, start in zip(out, chosen * step):
        part = data[start : start + size]
        row[: len(part)] = part
    return out


@dataclass(frozen=True)
class Network:
    """``tables[w]`` has shape (w, CLASSES, FILTERS); ``weights`` maps the kept maxima to languages."""

    languages: tuple[str, ...]
    tables: dict[int, np.ndarray]
    weights: np.ndarray
    bias: np.ndarray

    @cached_property
    def _pair_tables(self) -> dict[int, list[np.ndarray]]:
        """For each width, a row of filter values per pair of classes and pair of offsets."""
        return {
            w: [(t[j][:, None, :] + t[j + 1][None, :, :]).reshape(-1, FILTERS) for j in range(0, w, 2)]
            for w, t in self.tables.items()
        }

    def log_probabilities(self, x: np.ndarray) -> np.ndarray:
        """One row per window of classes."""
        pairs = x[:, :-1].astype(np.int32) * CLASSES + x[:, 1:]
        kept = []
        for w, tables in self._pair_tables.items():
            n = x.shape[1] - w + 1
            value = tables[0][pairs[:, :n]]
            for j, table in enumerate(tables[1:], 1):
                value += table[pairs[:, 2 * j : 2 * j + n]]
            kept.append(value.max(axis=1))
        logits = np.maximum(np.hstack(kept), 0) @ self.weights + self.bias
        logits -= logits.max(axis=1, keepdims=True)
        return logits - np.log(np.exp(logits).sum(axis=1, keepdims=True))

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """(language, probability) of each text; texts without a letter are undetermined with probability 0."""
        found = [(UNDETERMINED, 0.0)] * len(texts)
        totals = np.zeros((len(texts), len(self.languages)))
        letters = np.zeros(len(texts))
        waiting: list[np.ndarray] = []
        owners: list[int] = []

        def run() -> None:
            x = np.vstack(waiting)
            weight = (x > 0).sum(axis=1).astype(float)
            np.add.at(totals, owners, self.log_probabilities(x) * weight[:, None])
            np.add.at(letters, owners, weight)
            waiting.clear()
            owners.clear()

        for i, text in enumerate(texts):
            if text and self.languages and _LETTER.search(text):
                own = windows(text)
                for at in range(0, len(own), WINDOWS_AT_ONCE):
                    part = own[at : at + WINDOWS_AT_ONCE]
                    waiting.append(part)
                    owners.extend([i] * len(part))
                    if len(owners) >= WINDOWS_AT_ONCE:
                        run()
        if waiting:
            run()
        for i in np.flatnonzero(letters):
            mean = totals[i] / letters[i]
            p = np.exp(mean - mean.max())
            p /= p.sum()
            best = int(p.argmax())
            found[i] = (self.languages[best], float(p[best]))
        return found


def fit(x: np.ndarray, y: np.ndarray, languages: tuple[str, ...], epochs: int = EPOCHS) -> Network:
    """Adam on the cross-entropy of labelled windows; the seed makes it repeatable."""
    draw = np.random.default_rng(SEED)
    n_lang = len(languages)
    values = {w: draw.normal(0, 0.1, (w, CLASSES, FILTERS)).astype(np.float32) for w in WIDTHS}
    values |= {
        "weights": draw.normal(0, 0.1, (len(WIDTHS) * FILTERS, n_lang)).astype(np.float32),
        "bias": np.zeros(n_lang, np.float32),
    }
    first = {k: np.zeros_like(v) for k, v in values.items()}
    second = {k: np.zeros_like(v) for k, v in values.items()}
    step = 0
    filters = np.arange(FILTERS)
    for epoch in range(epochs):
        for rows in np.array_split(draw.permutation(len(x)), max(1, len(x) // BATCH)):
            xb, yb = x[rows], y[rows]
            net = Network(languages, {w: values[w] for w in WIDTHS}, values["weights"], values["bias"])
            kept, places = [], []
            pairs = xb[:, :-1].astype(np.int32) * CLASSES + xb[:, 1:]
            for w, tables in net._pair_tables.items():
                n = xb.shape[1] - w + 1
                value = sum(t[pairs[:, 2 * j : 2 * j + n]] for j, t in enumerate(tables))
                place = value.argmax(axis=1)
                places.append(place)
                kept.append(np.take_along_axis(value, place[:, None, :], axis=1)[:, 0])
            h = np.hstack(kept)
            active = np.maximum(h, 0)
            logits = active @ values["weights"] + values["bias"]
            p = np.exp(logits - logits.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(yb)), yb] -= 1
            p /= len(yb)
            slopes = {"weights": active.T @ p, "bias": p.sum(axis=0)}
            back = (p @ values["weights"].T) * (h > 0)
            for k, w in enumerate(WIDTHS):
                part, slope = back[:, k * FILTERS : (k + 1) * FILTERS], np.zeros_like(values[w])
                for j in range(w):
                    seen = np.take_along_axis(xb, places[k] + j, axis=1)
                    np.add.at(slope[j], (seen, np.broadcast_to(filters, seen.shape)), part)
                slopes[w] = slope
            step += 1
            for k, slope in slopes.items():
                first[k] += 0.1 * (slope - first[k])
                second[k] += 0.001 * (slope * slope - second[k])
                unbiased = first[k] / (1 - 0.9**step), second[k] / (1 - 0.999**step)
                values[k] -= (0.01 * 0.5**epoch * unbiased[0] / (np.sqrt(unbiased[1]) + 1e-8)).astype(np.float32)
    return Network(languages, {w: values[w] for w in WIDTHS}, values["weights"], values["bias"])


def train(docs: DataFrame, max_docs: int = MAX_DOCS) -> Network:
    """A network from documents with text and language that are not held out, about ``max_docs`` per language.

    They are chosen by a hash of their ids. Without any such document the network knows no language and finds
    every text undetermined.
    """
    bounded_batches(docs.sparkSession)
    usable = text_rows(docs, "doc_id", "text", "lang").filter(
        F.col("text").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("doc_id"))
    )
    sizes = {r.lang: r.n for r in usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = tuple(sorted(sizes))
    if not languages:
        return Network((), {}, np.zeros((0, 0)), np.zeros(0))
    of_language = F.create_map(*[F.lit(v) for lang in languages for v in (lang, min(1.0, max_docs / sizes[lang]))])
    draw = F.pmod(F.xxhash64(F.lit(SEED), "doc_id"), F.lit(1_000_000)) / 1_000_000
    chosen = usable.filter(draw < F.element_at(of_language, F.col("lang"))).select("lang", "text")

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, cut = [], []
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                if _LETTER.search(text):
                    for row in windows(text, at_most=TRAINING_WINDOWS):
                        langs.append(lang)
                        cut.append(row.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(cut, pa.binary())], names=["lang", "x"])

    rows = chosen.mapInArrow(sample, "lang string, x binary").orderBy("x", "lang").toArrow()
    if not rows.num_rows:
        return Network((), {}, np.zeros((0, 0)), np.zeros(0))
    number = {lang: i for i, lang in enumerate(languages)}
    x = np.frombuffer(b"".join(rows.column("x").to_pylist()), np.uint8).reshape(-1, WINDOW)
    y = np.array([number[lang] for lang in rows.column("lang").to_pylist()])
    return fit(x, y, languages)


def identify_language(docs: DataFrame, network: Network, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, held_out, lang_pred, score.

    ``und`` and 0 for a null text or one without a letter. Repeated rows are judged alike. Other columns are
    ignored, whatever their names.
    """
    bounded_batches(docs.sparkSession)
    source = text_rows(docs, id_col, text_col).select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = network.predict(batch.column("text").to_pylist())
            columns = [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names=["doc_id", "lang_pred", "score"])

    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(compute, f"doc_id {kind}, lang_pred string, score double").select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score"
    )
