"""License scans: MinHash bands over overlapping windows find candidates, exact containment decides.

Words are runs of ASCII letters, digits and other bytes of UTF-8 letters, lower-cased; shingles are five words.
Windows of 1, 2, 4 and 8 shingles start at every word of a text. A template is cut into windows of the largest
of these sizes that fits it, so wherever a text holds the template unchanged it holds a window with the same
shingles, and equal sets collide in all bands. Windows of similarity s collide in some band with probability
1 - (1 - s^ROWS)^BANDS: 0.9998 at 0.8. A collision is only a candidate: around it the share of the template's
shingles that the text holds is counted, and from ``CONTAINMENT`` on it is a match.

Texts are scanned in the tasks that read them; nothing is shuffled.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left
from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from functools import cached_property
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from riskflow.llm.common import bounded_batches, text_rows
from riskflow.llm.license_texts import OTHER_VERSIONS, SHINGLE, TEMPLATES, body_windows

SIZES = (1, 2, 4, 8)
BANDS, ROWS = 8, 2
CONTAINMENT = 0.8
SHORT_WORDS = 20  # a template up to this length needs its version words
SLACK = 0.25  # a match may be this much longer than its template
SEED = 11
BITMAP_BITS = 16
BLOCK_SHINGLES = 1 << 15  # scanned at a time
LOW = np.uint32((1 << BITMAP_BITS) - 1)
_WORD = re.compile(rb"[a-z0-9\x80-\xff]+")


def words_of(text: str | None) -> list[bytes]:
    return _WORD.findall((text or "").encode("utf-8", "surrogatepass").lower())


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_hashes(words: list[bytes]) -> np.ndarray:
    """One hash per shingle; none if there are fewer than five words."""
    if len(words) < SHINGLE:
        return np.zeros(0, np.uint64)
    codes = np.fromiter(map(zlib.crc32, words), np.uint64, len(words))
    n = len(words) - SHINGLE + 1
    total = np.zeros(n, np.uint64)
    for i in range(SHINGLE):
        total = total * np.uint64(0x9E3779B97F4A7C15) + codes[i : i + n]
    return _mixed(total)


def band_keys(hashes: np.ndarray, sizes: tuple[int, ...] = SIZES) -> Iterator[tuple[int, int, np.ndarray]]:
    """(window size, band, key of each window start), for the sizes that fit."""
    draw = np.random.default_rng(SEED)
    odd = draw.integers(1 << 62, size=BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    for band in range(BANDS):
        minima = [((hashes * odd[band * ROWS + row]) >> np.uint64(32)).astype(np.uint32) for row in range(ROWS)]
        reach = 1
        for size in sizes:
            if size > len(hashes):
                break
            if size > reach:
                minima = [np.minimum(m[:-reach], m[reach:]) for m in minima]
                reach = size
            key = minima[0]
            for m in minima[1:]:
                key = key * np.uint32(0x9E3779B1) + m
            yield size, band, key


@dataclass(frozen=True)
class Match:
    license_id: str
    template: str
    start_word: int
    end_word: int
    containment: float


class Scanner:
    """Templates with their band tables, made once per worker."""

    def __init__(self, templates: Mapping[tuple[str, str], str] | None = None) -> None:
        templates = templates or TEMPLATES | OTHER_VERSIONS | body_windows()
        self._names = list(templates)
        self._words = [words_of(text) for text in templates.values()]

    @cached_property
    def _shingles(self) -> list[set[tuple[bytes, ...]]]:
        return [set(zip(*(w[i:] for i in range(SHINGLE)))) for w in self._words]

    @cached_property
    def _versions(self) -> list[set[bytes]]:
        """The version words of each short template."""
        return [{w for w in t if any(48 <= b < 58 for b in w)} if len(t) <= SHORT_WORDS else set() for t in self._words]

    @cached_property
    def _tables(self) -> dict[tuple[int, int], tuple[np.ndarray, dict[int, list[tuple[int, int]]]]]:
        """By window size and band: a bitmap of the keys' last bits, and the template windows of each key."""
        found: dict[tuple[int, int], dict[int, list[tuple[int, int]]]] = {}
        for template, words in enumerate(self._words):
            hashes = shingle_hashes(words)
            size = max((s for s in SIZES if s <= len(hashes)), default=0)
            if not size:
                continue
            last = len(hashes) - size
            starts = sorted({*range(0, last + 1, max(1, size // 2)), last})
            for of_size, band, keys in band_keys(hashes):
                for start in starts if of_size == size else ():
                    found.setdefault((size, band), {}).setdefault(int(keys[start]), []).append((template, start))
        tables = {}
        for place, by_key in found.items():
            bitmap = np.zeros(1 << BITMAP_BITS, bool)
            bitmap[np.array(list(by_key), np.uint32) & LOW] = True
            tables[place] = (bitmap, by_key)
        return tables

    def candidates(self, texts: list[list[bytes]]) -> list[set[tuple[int, int]]]:
        """For each text (template, word at which it would start) of each collision.

        Texts are laid end to end, so that short ones cost no more per word than long ones; windows across an
        end are dropped.
        """
        hashes = shingle_hashes([word for words in texts for word in words])
        ends = np.cumsum([len(words) for words in texts])
        found: list[set[tuple[int, int]]] = [set() for _ in texts]
        for base in range(0, len(hashes), BLOCK_SHINGLES):
            # Blocks overlap by the largest window, so no window is lost between them.
            for size, band, keys in band_keys(hashes[base : base + BLOCK_SHINGLES + SIZES[-1] - 1]):
                if (size, band) not in self._tables:
                    continue
                bitmap, by_key = self._tables[size, band]
                hits = np.flatnonzero(bitmap[keys & LOW])
                in_text = np.searchsorted(ends, base + hits, side="right").tolist()
                for at, key, text in zip(hits.tolist(), keys[hits].tolist(), in_text):
                    for template, start in by_key.get(key, ()):
                        if base + at + size + SHINGLE - 1 <= ends[text]:
                            first = int(ends[text]) - len(texts[text])
                            found[text].add((template, base + at - first - start))
        return found

    def scan(self, texts: list[str | None]) -> list[list[Match]]:
        """The matches of each text."""
        worded = [words_of(text) for text in texts]
        return [self._verified(*pair) if pair[1] else [] for pair in zip(worded, self.candidates(worded))]

    def _verified(self, words: list[bytes], candidates: set[tuple[int, int]]) -> list[Match]:
        """Matches in the order of their places; of overlapping ones of a template the best, then the first.

        Of different templates, one goes whose words mostly lie in matches that hold more shingles. A short
        template must hold a shingle with each of its version words.
        """
        scored = []
        for template, at in candidates:
            length, wanted = len(self._words[template]), self._shingles[template]
            slack = int(SLACK * length)
            start, end = max(0, at - slack), min(len(words), at + length + slack)
            places: dict[tuple[bytes, ...], int] = {}
            for i in range(start, end - SHINGLE + 1):
                shingle = tuple(words[i : i + SHINGLE])
                # Of a repeated shingle the one next to where it should be.
                if shingle in wanted and (shingle not in places or abs(i - at) < abs(places[shingle] - at)):
                    places[shingle] = i
            share = len(places) / len(wanted)
            if share >= CONTAINMENT and not self._versions[template].difference(*places):
                scored.append((-share, min(places.values()), max(places.values()) + SHINGLE, template))
        taken: dict[int, list[tuple[int, int]]] = {}
        matches = []
        for share, start, end, template in sorted(scored):
            spans = taken.setdefault(template, [])  # sorted, and none overlaps another
            place = bisect_left(spans, (start, end))
            if (not place or spans[place - 1][1] <= start) and (place == len(spans) or spans[place][0] >= end):
                spans.insert(place, (start, end))
                matches.append((round(-share * len(self._shingles[template])), Match(*self._names[template], start, end, -share)))
        matches = self._best(matches)
        return sorted(matches, key=lambda m: (m.start_word, m.end_word, m.license_id, m.template))

    @staticmethod
    def _best(found: list[tuple[int, Match]]) -> list[Match]:
        """The matches that no stretch of matches with more shingles covers by more than half."""
        best, covered = [], set()
        for _, equal in groupby(sorted(found, key=lambda f: -f[0]), key=lambda f: f[0]):
            spans = [(m, range(m.start_word, m.end_word)) for _, m in equal]
            staying = [(m, span) for m, span in spans if 2 * sum(i in covered for i in span) <= len(span)]
            best += [m for m, _ in staying]
            covered.update(*(span for _, span in staying))
        return best


def scan_licenses(
    docs: DataFrame,
    templates: Mapping[tuple[str, str], str] | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """A row per match: doc_id, license_id, template, start_word, end_word, containment, passage.

    ``passage`` is the matched part of the text as it stands. Null, empty and short texts match nothing;
    repeated rows each give their matches. Other columns are ignored, whatever their names. ``templates``
    replaces the built-in ones: texts by (license, name).
    """
    bounded_batches(docs.sparkSession)
    source = text_rows(docs, id_col, text_col).select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates)
        names = ["doc_id", "license_id", "template", "start_word", "end_word", "containment", "passage"]
        for batch in batches:
            rows = []
            texts = batch.column("text").to_pylist()
            for doc_id, text, found in zip(batch.column("doc_id").to_pylist(), texts, scanner.scan(texts)):
                if found:
                    data = text.encode("utf-8", "surrogatepass")
                    spans = [m.span() for m in _WORD.finditer(data.lower())]
                    for m in found:
                        part = data[spans[m.start_word][0] : spans[m.end_word - 1][1]]
                        values = (m.license_id, m.template, m.start_word, m.end_word, m.containment)
                        rows.append((doc_id, *values, part.decode("utf-8", "replace")))
            if rows:
                types = [batch.column("doc_id").type, pa.string(), pa.string(), pa.int32(), pa.int32(), pa.float64(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(
        compute,
        f"doc_id {kind}, license_id string, template string, start_word int, end_word int, "
        "containment double, passage string",
    )
