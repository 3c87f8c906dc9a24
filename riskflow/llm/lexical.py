"""Ranked lexical search by Block-Max MaxScore over an inverted index in shards.

A shard holds the postings of some consecutive documents of a task. A posting list is cut into blocks of
``BLOCK`` documents, each coded by itself: document numbers as differences, both they and the term frequencies in as
few bytes as the block needs. A block's head says where its documents start and names its competitive pairs, the
(frequency, length) of which no other posting of the block is better in both. So the largest score in a block is
known exactly without decoding it, whatever the corpus statistics are when it is searched.

A search reads the lists of its terms only, shard by shard. Lists are ordered by their bounds, the largest block
maximum. Those whose bounds cannot reach the k-th best score together are non-essential: documents are drawn from
the others. On non-essential lists a candidate is looked up in the block heads, and rejected if its score so far
and the maxima of its blocks stay below; only blocks with candidates left are decoded. A task keeps a heap per
query over all its shards, whose k-th score serves as threshold for the next ones, and the heaps are merged.
"""

from __future__ import annotations

import heapq
import math
import string
from collections import defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from riskflow.llm.common import bounded_batches, text_rows
from riskflow.session import materialize

BLOCK = 128
SHARD_DOCS = 1 << 14  # a document's number in its shard fits two bytes
SHARD_TERMS = 1 << 21  # terms with repeats after which a shard ends; a longer document is one alone
TOP = 50
BASE = 50  # of 100, the share of the length norm that does not depend on the length
QUERY_TERMS = 1 << 17  # (query, term) pairs that are searched at a time
MERGE_SHARDS = 64

_SEPARATORS = [i for i in range(128) if not chr(i).isalnum()]
_TABLE = bytes.maketrans(
    string.ascii_uppercase.encode() + bytes(_SEPARATORS), string.ascii_lowercase.encode() + b" " * len(_SEPARATORS)
)


def terms_of(text: str | None) -> list[bytes]:
    """Runs of ASCII letters, digits and all other characters beyond ASCII; only A-Z lower-cased."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_TABLE).split()


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def impact(tf: np.ndarray, norm: np.ndarray) -> np.ndarray:
    """What a term adds to a document's score, before its weight."""
    return (1_000_000_000 * tf) // (1000 * tf + 20 * norm)


def norms(lengths: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """The length norm of documents; whole numbers of any size in between."""
    return np.array([100 - BASE + BASE * int(n) * n_docs // n_terms for n in lengths], np.int64)


class ShardBuilder:
    """Documents of one shard, and their posting lists."""

    def __init__(self):
        self.numbers: dict[bytes, int] = defaultdict(count().__next__)
        self.codes: list[np.ndarray] = []
        self.ids: list = []
        self.size = 0

    def add(self, doc_id, terms: list[bytes]) -> None:
        self.codes.append(np.fromiter(map(self.numbers.__getitem__, terms), np.int64, len(terms)))
        self.ids.append(doc_id)
        self.size += len(terms)

    def full(self) -> bool:
        return self.size >= SHARD_TERMS or len(self.ids) >= SHARD_DOCS

    def rows(self, shard: int, id_type: pa.DataType) -> pa.RecordBatch:
        """A row per term, and one with a null term for the documents."""
        lengths = np.array([len(c) for c in self.codes], np.int64)
        keys = np.concatenate(self.codes) << 16 | np.repeat(np.arange(len(lengths)), lengths)
        keys.sort()
        starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        tf = np.diff(np.r_[starts, len(keys)])
        term, doc = keys[starts] >> 16, keys[starts] & 0xFFFF
        first = np.flatnonzero(np.r_[True, term[1:] != term[:-1]])
        df = np.diff(np.r_[first, len(term)])
        heads, head_ends, data, data_ends = encoded(doc, tf, lengths[doc], first, df)
        terms = list(self.numbers)
        order = term[first]
        n = len(order)

        def binary(ends: np.ndarray, values: np.ndarray) -> pa.Array:
            offsets = np.r_[0, ends].astype("<i4")
            return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(values)])

        columns = [
            pa.array(np.full(n + 1, shard, np.int64)),
            pa.array([None, *(terms[i].decode("utf-8", "surrogatepass") for i in order)], pa.string()),
            pa.array(np.r_[len(lengths), df]),
            pa.array(np.r_[len(keys), np.add.reduceat(tf, first)]),
            pa.concat_arrays([pa.array([lengths.astype("<i8").tobytes()]), binary(head_ends, heads)]),
            pa.concat_arrays([pa.array([b""]), binary(data_ends, data)]),
            pa.array([self.ids, *[None] * n], pa.list_(id_type)),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["shard", "term", "n", "total", "head", "data", "ids"])


def encoded(
    doc: np.ndarray, tf: np.ndarray, length: np.ndarray, first: np.ndarray, df: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Heads and coded blocks of posting lists that start at ``first``, with where those of each list end.

    A head has, per block, the first document (2 bytes), the bytes per difference and per frequency (1 byte each)
    and the number of pairs (1 byte), and then the pairs of all blocks (8 bytes each).
    """
    within = np.arange(len(doc)) - np.repeat(first, df)
    opens = within % BLOCK == 0
    block = np.cumsum(opens) - 1
    at = np.flatnonzero(opens)
    size = np.diff(np.r_[at, len(doc)])
    gap = np.where(opens, 0, np.diff(doc, prepend=0))
    wide_gap = np.where(np.maximum.reduceat(gap, at) < 256, 1, 2)
    wide_tf = np.where(np.maximum.reduceat(tf, at) < 256, 1, 4)
    # Competitive pairs: by rising length, those with more occurrences than any shorter posting of the block.
    order = np.lexsort((-tf, length, block))
    ranked = block[order] << 40 | tf[order]
    best = np.maximum.accumulate(ranked)
    competes = np.r_[True, ranked[1:] > best[:-1]]
    pair_block, pairs = block[order][competes], np.stack([tf[order], length[order]], 1)[competes].astype("<u4")
    n_pairs = np.bincount(pair_block, minlength=len(at))

    blocks_of = -(-df // BLOCK)
    list_of = np.repeat(np.arange(len(first)), blocks_of)
    head_size = 5 * blocks_of + 8 * np.bincount(list_of, n_pairs, len(first)).astype(np.int64)
    head_ends = np.cumsum(head_size)
    heads = np.zeros(int(head_ends[-1]), np.uint8)
    head_starts = head_ends - head_size
    nth = np.arange(len(at)) - np.repeat(np.cumsum(blocks_of) - blocks_of, blocks_of)
    n_blocks = blocks_of[list_of]
    base = head_starts[list_of]
    heads[base + 2 * nth] = doc[at] & 255
    heads[base + 2 * nth + 1] = doc[at] >> 8
    heads[base + 2 * n_blocks + nth] = wide_gap
    heads[base + 3 * n_blocks + nth] = wide_tf
    heads[base + 4 * n_blocks + nth] = n_pairs - 1  # 1 to 128
    pair_starts = np.cumsum(n_pairs) - n_pairs
    pairs_before = pair_starts - pair_starts[np.repeat(np.cumsum(blocks_of) - blocks_of, blocks_of)]
    pair_at = base[pair_block] + 5 * n_blocks[pair_block] + 8 * (
        pairs_before[pair_block] + np.arange(len(pair_block)) - pair_starts[pair_block]
    )
    heads[pair_at[:, None] + np.arange(8)] = pairs.view(np.uint8).reshape(-1, 8)

    block_size = size * (wide_gap + wide_tf)
    block_ends = np.cumsum(block_size)
    block_starts = block_ends - block_size
    data = np.zeros(int(block_ends[-1]), np.uint8)
    inside = np.arange(len(doc)) - at[block]
    for values, wide, start in ((gap, wide_gap, block_starts), (tf, wide_tf, block_starts + size * wide_gap)):
        place = start[block] + inside * wide[block]
        for byte in range(4):
            some = wide[block] > byte
            data[place[some] + byte] = values[some] >> 8 * byte & 255
    return heads, head_ends, data, block_ends[np.cumsum(blocks_of) - 1]


class PostingList:
    """A term's postings in one shard. Blocks are decoded when they are asked for, each once."""

    def __init__(self, n: int, head: bytes, data: bytes, n_docs: int, n_terms: int, norm: np.ndarray):
        blocks = -(-n // BLOCK)
        raw = np.frombuffer(head, np.uint8)
        self.first = raw[: 2 * blocks].view("<u2").astype(np.int64)
        self.wide_gap, self.wide_tf = raw[2 * blocks : 3 * blocks], raw[3 * blocks : 4 * blocks]
        n_pairs = raw[4 * blocks : 5 * blocks].astype(np.int64) + 1
        pairs = raw[5 * blocks :].copy().view("<u4").astype(np.int64).reshape(-1, 2)
        best = impact(pairs[:, 0], norms(pairs[:, 1], n_docs, n_terms))
        self.maxima = np.maximum.reduceat(best, np.cumsum(n_pairs) - n_pairs)
        self.bound = int(self.maxima.max())
        self.size = np.full(blocks, BLOCK)
        self.size[-1] = n - BLOCK * (blocks - 1)
        widths = self.wide_gap.astype(np.int64) + self.wide_tf
        self.start = np.cumsum(self.size * widths) - self.size * widths
        self.data, self.norm = data, norm
        self.decoded: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def block(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """(documents, impacts) of a block."""
        if i not in self.decoded:
            n, start = int(self.size[i]), int(self.start[i])
            gaps = np.frombuffer(self.data, f"<u{self.wide_gap[i]}", n, start)
            tf = np.frombuffer(self.data, f"<u{self.wide_tf[i]}", n, start + n * int(self.wide_gap[i])).astype(np.int64)
            docs = self.first[i] + np.cumsum(gaps, dtype=np.int64)
            self.decoded[i] = docs, impact(tf, self.norm[docs])
        return self.decoded[i]

    @cached_property
    def all(self) -> tuple[np.ndarray, np.ndarray]:
        parts = [self.block(i) for i in range(len(self.first))]
        return np.concatenate([d for d, _ in parts]), np.concatenate([x for _, x in parts])

    def blocks_of(self, docs: np.ndarray) -> np.ndarray:
        """The block that would hold each document; -1 before the first."""
        return np.searchsorted(self.first, docs, "right") - 1

    def maxima_of(self, blocks: np.ndarray) -> np.ndarray:
        return np.where(blocks < 0, 0, self.maxima[blocks])

    def impacts_of(self, docs: np.ndarray, blocks: np.ndarray) -> np.ndarray:
        """The impacts on ``docs``, in order, decoding only the blocks that could hold one."""
        found = np.zeros(len(docs), np.int64)
        starts = np.flatnonzero(np.diff(blocks, prepend=-1))
        for start, end in zip(starts, [*starts[1:], len(docs)]):
            held, impacts = self.block(int(blocks[start]))
            place = np.minimum(np.searchsorted(held, docs[start:end]), len(held) - 1)
            found[start:end] = np.where(held[place] == docs[start:end], impacts[place], 0)
        return found


def search_shard(
    lists: Sequence[tuple[int, PostingList]], n_docs: int, k: int, threshold: int
) -> tuple[np.ndarray, np.ndarray]:
    """(documents, scores) of the shard: all that reach ``threshold`` and can be among the ``k`` best, and maybe others.

    ``lists`` are (weight, postings). Scores are whole.
    """
    lists = sorted(lists, key=lambda x: -x[0] * x[1].bound)
    bounds = [w * postings.bound for w, postings in lists]
    rest = list(np.cumsum(bounds[::-1])[::-1]) + [0]  # rest[i]: what the lists from i on can add
    score = np.zeros(n_docs, np.int64)
    essential = 0
    while essential < len(lists) and rest[essential] >= max(threshold, 1):
        w, postings = lists[essential]
        docs, impacts = postings.all
        score[docs] += w * impacts
        essential += 1
        if rest[essential] < score.max() and n_docs >= k:
            threshold = max(threshold, int(np.partition(score, n_docs - k)[n_docs - k]))
    docs = np.flatnonzero((score > 0) & (score + rest[essential] >= threshold))
    reached = score[docs]
    others = lists[essential:]
    blocks = [postings.blocks_of(docs) for _, postings in others]
    maxima = [w * postings.maxima_of(b) for (w, postings), b in zip(others, blocks)]
    for i, (w, postings) in enumerate(others):
        left = reached + sum(maxima[i:]) >= threshold
        if not left.all():
            docs, reached = docs[left], reached[left]
            blocks, maxima = [b[left] for b in blocks], [m[left] for m in maxima]
        if not len(docs):
            break
        reached = reached + w * postings.impacts_of(docs, blocks[i])
    return docs, reached


@dataclass(frozen=True)
class Query:
    number: int
    terms: dict[str, int]  # weights


def _rank(found: tuple[int, object]) -> tuple:
    score, doc_id = found
    return -score, doc_id is None, doc_id if doc_id is not None else 0


def _searched(batches: Iterator[pa.RecordBatch], queries: Sequence[Query], n_docs: int, n_terms: int, k: int):
    """The ``k`` best (score, id) of each query over the shards that a task reads, in the order of shards."""
    best: dict[int, list] = {q.number: [] for q in queries}

    def search(ids: list, lengths: np.ndarray, stored: dict[str, tuple[int, bytes, bytes]]) -> None:
        norm = norms(lengths, n_docs, n_terms)
        lists = {t: PostingList(*row, n_docs, n_terms, norm) for t, row in stored.items()}
        for q in queries:
            heap = best[q.number]
            threshold = heap[-1][0] if len(heap) == k else 0
            own = [(w, lists[t]) for t, w in q.terms.items() if t in lists]
            docs, scores = search_shard(own, len(ids), k, threshold)
            reach = max(threshold, 1)
            if len(scores) > k:
                reach = max(reach, int(np.partition(scores, len(scores) - k)[len(scores) - k]))
            good = np.flatnonzero(scores >= reach)
            if len(good):
                heap += [(int(scores[i]), ids[docs[i]]) for i in good]
                best[q.number] = heapq.nsmallest(k, heap, _rank)

    last, ids, lengths, stored = None, [], None, {}
    for batch in batches:
        for shard, term, n, head, data, own in zip(*[batch.column(c).to_pylist() for c in batch.schema.names]):
            if shard != last:
                if stored:
                    search(ids, lengths, stored)
                last, stored = shard, {}
            if term is None:
                ids, lengths = own, np.frombuffer(head, "<i8")
            else:
                stored[term] = n, head, data
    if stored:
        search(ids, lengths, stored)
    return best


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The stored index: (shard, term, n, total, head, data, ids).

    A row per shard and term with the number of documents and occurrences, and one per shard with a null term,
    whose head has the documents' lengths. Documents without a term are left out, as no query finds them.
    """
    bounded_batches(docs.sparkSession)
    source = text_rows(docs, id_col, text_col).select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    id_type = source.schema["doc_id"].dataType.simpleString()

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, builder = TaskContext.get().partitionId() << 32, ShardBuilder()
        kind = pa.null()
        for batch in batches:
            kind = batch.schema.field("doc_id").type
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                if terms := terms_of(text):
                    builder.add(doc_id, terms)
                    if builder.full():
                        yield builder.rows(shard, kind)
                        shard, builder = shard + 1, ShardBuilder()
        if builder.ids:
            yield builder.rows(shard, kind)

    schema = f"shard bigint, term string, n bigint, total bigint, head binary, data binary, ids array<{id_type}>"
    return materialize(source.mapInArrow(build, schema), "index")


def _query_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(number, item_id, term, block): distinct items with their distinct terms, cut into blocks of bounded size."""
    source = text_rows(items, id_col, text_col).select(F.col(id_col).alias("item_id"), F.col(text_col).alias("text"))
    id_type = source.schema["item_id"].dataType.simpleString()

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted({t.decode("utf-8", "surrogatepass") for t in terms_of(x)}) for x in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("item_id"), pa.array(found, pa.list_(pa.string()))], names=["item_id", "terms"]
            )

    found = source.mapInArrow(explode, f"item_id {id_type}, terms array<string>").filter(F.size("terms") > 0).distinct()
    numbered = found.withColumn("number", F.monotonically_increasing_id()).withColumn("part", F.spark_partition_id())
    numbered = materialize(numbered.withColumn("n", F.size("terms").cast("bigint")), "items")
    # The terms before an item: before its part, of which there are few, and before it within its part.
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = numbered.groupBy("part").agg(F.sum("n").alias("n"))
    parts = materialize(parts.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset")), "parts")
    within = Window.partitionBy("part").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("offset") + F.coalesce(F.sum("n").over(within), F.lit(0))
    block = F.floor(before / QUERY_TERMS).alias("block")
    cut = numbered.join(parts, "part").select("number", "item_id", "terms", block)
    return materialize(cut.select("number", "item_id", F.explode("terms").alias("term"), "block"), "query-terms")


def search(
    index: DataFrame, items: DataFrame, id_col: str = "item_id", text_col: str = "text", k: int = TOP
) -> DataFrame:
    """The ``k`` best documents of each item with a score above 0: item_id, rank, doc_id, score.

    Equal scores go by ascending doc_id, a null id last. Terms count once per item. Items without a term find
    nothing; repeated items are searched once, items that share an id but not their terms each get their own ranks.
    Other columns are ignored. An empty index or table of items gives an empty result.
    """
    spark = index.sparkSession
    documents = index.filter("term IS NULL")
    n_docs, n_terms = documents.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("total"), F.lit(0))).head()
    asked = _query_terms(items, id_col, text_col)
    id_type = index.schema["ids"].dataType.elementType.simpleString()
    schema = f"number bigint, doc_id {id_type}, score bigint, some bigint"
    merged = spark.createDataFrame([], schema)
    blocks = asked.agg(F.coalesce(F.max("block") + 1, F.lit(0))).head()[0]
    for block in range(blocks):
        own = asked.filter(F.col("block") == block)
        terms = own.select("term").distinct()  # bounded like the block
        lists = index.join(F.broadcast(terms), "term")
        df = lists.groupBy("term").agg(F.sum("n").alias("df"))
        weighted = own.join(df, "term").select("number", "term", "df").collect()
        weights: dict[int, dict[str, int]] = defaultdict(dict)
        for r in weighted:
            if (w := weight(n_docs, r.df)) > 0:
                weights[r.number][r.term] = w
        queries = [Query(number, own_terms) for number, own_terms in weights.items()]
        if queries:
            merged = merged.unionByName(_search_block(lists, documents, queries, n_docs, n_terms, k, schema))
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    some = F.row_number().over(Window.partitionBy("number", "some").orderBy(*order))
    best = merged.withColumn("at", some).filter(F.col("at") <= k)
    rank = F.row_number().over(Window.partitionBy("number").orderBy(*order))
    ranked = best.withColumn("rank", rank).filter(F.col("rank") <= k)
    names = asked.select("number", "item_id").distinct()
    return ranked.join(names, "number").select("item_id", "rank", "doc_id", "score")


def _search_block(lists, documents, queries, n_docs, n_terms, k, schema) -> DataFrame:
    """(number, doc_id, score, some): the heaps of all tasks; ``some`` spreads those of a query."""
    columns = ["shard", "term", "n", "head", "data", "ids"]
    rows = lists.select(*columns).unionByName(documents.select(*columns))
    dealt = rows.repartition("shard").sortWithinPartitions("shard")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _searched(batches, queries, n_docs, n_terms, k)
        numbers = [number for number, heap in best.items() for _ in heap]
        ids = [doc_id for heap in best.values() for _, doc_id in heap]
        scores = [score for heap in best.values() for score, _ in heap]
        some = np.full(len(numbers), TaskContext.get().partitionId() % MERGE_SHARDS)
        yield pa.RecordBatch.from_arrays(
            [pa.array(numbers, pa.int64()), pa.array(ids), pa.array(scores, pa.int64()), pa.array(some)],
            names=["number", "doc_id", "score", "some"],
        )

    return materialize(dealt.mapInArrow(run, schema), "heaps")


def rank_documents(docs: DataFrame, items: DataFrame, k: int = TOP) -> DataFrame:
    """The ``k`` best of all documents (doc_id, text) for each item (item_id, text)."""
    return search(build_index(docs), items, k=k)
