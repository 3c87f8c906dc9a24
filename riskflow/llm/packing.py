"""Best-fit packing of documents into token sequences by bin completion.

A document is its token ids and an end id. One that is longer than a sequence is cut into full sequences and
one shorter first piece. Each task packs the documents it reads, so nothing is shuffled, documents keep the
neighbourhood that mixing gave them, and a lost task is repeated alone. Full pieces leave a task at once; the
others wait in a window of ``WINDOW_PIECES``, which bounds memory, and are packed together.

Tokens come from a ``tokenizers`` file. Byte-level pre-tokenization never joins characters across a single
space or line end between two other characters, so these split a text into parts whose ids do not depend on
each other, and the ids of a part are looked up once per worker. A text with other runs of white space is
tokenized whole.
"""

from __future__ import annotations

import json
import os
import re
import struct
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from riskflow.llm.bin_completion import MAX_STEPS, pack
from riskflow.llm.common import bounded_batches, text_rows

SEQUENCE_TOKENS = 1024
END_ID = 2
WINDOW_PIECES = 8192
CACHED_PARTS = 500_000
ID_BYTES = 4
COLUMNS = ("doc_id", "piece", "start", "length", "ids", "sequence_id", "offset")
_PLAIN_WORD = re.compile(r"\n?[A-Za-zÀ-ÖØ-öø-ÿ]{1,30}[,.]?")
_PACK_IDS = [struct.Struct(f"<{n}I").pack for n in range(64)]
_SPACE_RUN = re.compile(r"\s\s")
_RARE_BLANKS = "\t\x0b\x0c\r\x1c\x1d\x1e\x1f"
_RUNS = ("  ", " \n", "\n ", "\n\n\n")

_tokens: dict[str, Tokens] = {}


def divisible(text: str) -> bool:
    """Whether every space and line end stands between two other characters, two line ends at most together."""
    if text[-1:].isspace():
        return False
    if text.isascii() and not any(c in text for c in _RARE_BLANKS):
        return not any(run in text for run in _RUNS)
    return _SPACE_RUN.search(text) is None


def parts_of(text: str) -> list[str]:
    """The parts of a divisible text: one that a line end precedes begins with it, the others had a space there."""
    return text.replace("\n", " \n").split(" ")


def _byte_characters() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: itself if it can be printed."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = sorted(set(range(256)).difference(plain))
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def _merger(path: str):
    """Merges byte pairs as the tokenizer file says, without its pre-tokenizer; None for other kinds of files.

    A file qualifies if it is plain byte-level BPE whose merges are numbered in the order in which they apply.
    """
    import tiktoken

    with open(path, encoding="utf-8") as file:
        data = json.load(file)
    model, before = data["model"], data.get("pre_tokenizer") or {}
    plain = model.get("type") == "BPE" and before.get("type") == "ByteLevel" and before.get("use_regex", True)
    if not plain or before.get("add_prefix_space") or data.get("normalizer") or model.get("dropout"):
        return None
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    vocabulary, byte_of = model["vocab"], _byte_characters()
    if model.get("ignore_merges") or any(vocabulary[a + b] != 256 + i for i, (a, b) in enumerate(pairs)):
        return None
    ranks = {bytes(byte_of[c] for c in t): i for t, i in vocabulary.items() if i < 256 + len(pairs)}
    return tiktoken.Encoding("merges", pat_str=r"[,.\n]|[^,.\n]+", mergeable_ranks=ranks, special_tokens={})


class Tokens:
    """Token ids of texts, as little-endian unsigned 32-bit numbers."""

    def __init__(self, path: str) -> None:
        # Spark's tasks use the cores; threads of the library's own would compete with them.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._merger = _merger(path)
        self._parts: dict[str, bytes] = {}

    @classmethod
    def at(cls, path: str) -> Tokens:
        """One per worker process and file."""
        if path not in _tokens:
            _tokens[path] = cls(path)
        return _tokens[path]

    def whole(self, texts: list[str]) -> list[bytes]:
        """Each text tokenized as it is."""
        found = self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]

    def _of_parts(self, parts: list[str]) -> dict[str, bytes]:
        """The ids of each part with the blank before it.

        A word of Latin letters, with a comma or full stop or without, needs no pre-tokenizer: its pieces are
        known, and merging their bytes is all that is left. Other parts go through the tokenizer.
        """
        merge = self._merger.encode_ordinary
        found, others = {}, []
        for part in parts:
            if _PLAIN_WORD.fullmatch(part):
                ids = merge(part if part[0] == "\n" else " " + part)
                found[part] = _PACK_IDS[len(ids)](*ids)
            else:
                others.append(part)
        found.update(zip(others, self.whole([p if p[0] == "\n" else " " + p for p in others])))
        return found

    def encode(self, texts: list[str]) -> list[bytes]:
        """The same ids as ``whole``, with the parts of divisible texts looked up."""
        known = self._parts
        if len(known) > CACHED_PARTS:
            known.clear()
        split = [parts_of(t) if self._merger and divisible(t) else [t] for t in texts]
        new: set[str] = set()
        for parts in split:
            new.update(set(parts[1:]).difference(known))
        if new:
            known.update(self._of_parts(list(new)))
        first = self.whole([parts[0] for parts in split])
        return [ids + b"".join(map(known.__getitem__, parts[1:])) for ids, parts in zip(first, split)]


def cut(length: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document: full ones behind a first one that may be shorter."""
    first = length % size or min(size, length)
    return [(0, first), *((start, size) for start in range(first, length, size))]


class _Packer:
    """Places pieces into sequences; rows come out as they are placed."""

    def __init__(self, size: int, window: int, max_steps: int, first_id: int) -> None:
        self._size, self._window, self._max_steps, self._next = size, window, max_steps, first_id
        self._waiting: dict[int, list[tuple]] = defaultdict(list)
        self._n_waiting = 0

    def add(self, doc_id, ids: bytes) -> Iterator[tuple]:
        for piece, (start, length) in enumerate(cut(len(ids) // ID_BYTES, self._size)):
            row = (doc_id, piece, start, length, ids[ID_BYTES * start : ID_BYTES * (start + length)])
            if length == self._size:
                yield (*row, self._next, 0)
                self._next += 1
            else:
                self._waiting[length].append(row)
                self._n_waiting += 1
        if self._n_waiting >= self._window:
            yield from self.flush()

    def flush(self) -> Iterator[tuple]:
        counts = [len(self._waiting.get(n, ())) for n in range(self._size + 1)]
        for lengths in pack(counts, self._size, self._max_steps):
            offset = 0
            for length in lengths:
                yield (*self._waiting[length].pop(), self._next, offset)
                offset += length
            self._next += 1
        self._waiting.clear()
        self._n_waiting = 0


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = SEQUENCE_TOKENS,
    window: int = WINDOW_PIECES,
    max_steps: int = MAX_STEPS,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids (binary), sequence_id, offset.

    ``tokenizer`` is the path of the file on every machine. A null text is empty, and a document without tokens
    is its end id alone. Repeated rows and rows without an id are packed like any other. Other columns are
    ignored, whatever their names. An empty table gives an empty result.
    """
    bounded_batches(docs.sparkSession)
    source = text_rows(docs, id_col, text_col).select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    end = np.array([END_ID], "<u4").tobytes()

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokens.at(tokenizer)
        packer = _Packer(size, window, max_steps, TaskContext.get().partitionId() << 40)
        id_type = None

        def table(rows: list[tuple]) -> pa.RecordBatch:
            types = (id_type, pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64())
            columns = [pa.array(values, kind) for values, kind in zip(zip(*rows), types)]
            return pa.RecordBatch.from_arrays(columns, names=list(COLUMNS))

        rows: list[tuple] = []
        for batch in batches:
            id_type = batch.column("doc_id").type
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), tokens.encode(texts)):
                for row in packer.add(doc_id, ids + end):
                    rows.append(row)
                    if len(rows) == 1024:
                        yield table(rows)
                        rows = []
        rows += packer.flush()
        for at in range(0, len(rows), 1024):
            yield table(rows[at : at + 1024])

    return source.mapInArrow(
        compute,
        f"doc_id {kind}, piece int, start bigint, length bigint, ids binary, sequence_id bigint, offset bigint",
    )


def with_digests(packed: DataFrame) -> DataFrame:
    """Every piece with a checksum of its ids."""
    return packed.withColumn("ids_crc32", F.crc32("ids"))
