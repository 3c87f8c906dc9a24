"""Near-duplicates by SimHash fingerprints and covering locality-sensitive hashing.

A fingerprint has 64 bits, each the majority of that bit over the hashes of the text's word shingles. Two
fingerprints link if they differ in at most ``RADIUS`` bits. Links are found without loss: each bit position
i gets a vector p(i) of RADIUS + 1 bits, and each non-zero vector v is a table that compares the positions
with odd p(i)·v. RADIUS differing positions span at most RADIUS dimensions, so some v is orthogonal to
all of them and the two fingerprints collide in its table, whatever the data (Pagh, "Locality-sensitive
Hashing without False Negatives"). 15 tables of about 34 compared bits hold the distinct fingerprints.

A bucket with more than ``BUCKET_ROWS`` fingerprints is not compared as a whole: the same construction over
the positions that its table ignores splits it into 15 smaller tables, twice if need be. After that a bucket
ignores at most 7 positions and has at most 128 members. Within a bucket only a spanning forest of the links
is emitted, and the forests of all buckets are joined to components.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from riskflow.llm.common import bounded_batches, one_of_each, packed_rows, text_rows
from riskflow.llm.components import connected_components
from riskflow.session import materialize

BITS = 64
RADIUS = 3
SHINGLE_WORDS = 3
HASH_SEED = 42
BUCKET_ROWS = 2000
CHUNK = 1 << 15  # shingles whose bits are counted at a time


def fingerprint(text: str | None, words_per_shingle: int = SHINGLE_WORDS) -> int:
    """The fingerprint as an unsigned number; zero for a text without words.

    Words are runs of characters other than space and \\t to \\r. Shingles count as often as they occur; a text
    with fewer words is one shingle.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) <= words_per_shingle:
        shingles: Iterable[bytes] = [b" ".join(words)]
        n = 1
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(words_per_shingle))))
        n = len(words) - words_per_shingle + 1
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(s, HASH_SEED) for s in shingles), np.uint64, n)
    counts = np.zeros(BITS, np.int64)
    for i in range(0, n, CHUNK):
        part = hashes[i : i + CHUNK].astype("<u8").view(np.uint8)
        counts += np.unpackbits(part, bitorder="little").reshape(-1, BITS).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > n, bitorder="little").tobytes(), "little")


def _digest(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digests: bool = False
) -> DataFrame:
    """(doc_id, fp): one row per input row, the fingerprint as a signed 64-bit number.

    With ``digests`` there is a third column, digest, the SHA-256 of the text.
    """
    bounded_batches(docs.sparkSession)
    source = text_rows(docs, id_col, text_col).select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    if digests:
        source = source.withColumn("digest", _digest(F.col("text")))

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.array([fingerprint(t) for t in batch.column("text").to_pylist()], np.uint64)
            columns, names = [batch.column("doc_id"), pa.array(values.view(np.int64))], ["doc_id", "fp"]
            if digests:
                columns, names = [*columns, batch.column("digest")], [*names, "digest"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    id_type = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(compute, f"doc_id {id_type}, fp bigint" + (", digest string" if digests else ""))


def covering_masks(positions: Iterable[int], radius: int = RADIUS) -> list[int]:
    """The compared positions of each table, as bit masks over ``positions``."""
    vectors = (1 << (radius + 1)) - 1
    given = list(positions)
    return [
        sum(1 << p for i, p in enumerate(given) if ((1 + i % vectors) & v).bit_count() % 2)
        for v in range(1, vectors + 1)
    ]


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def _keyed(fps: DataFrame, masks: dict[int, int]) -> DataFrame:
    """(t, key, fp): the bucket of each fingerprint in each table."""
    tables = F.array(
        *[
            F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key"))
            for t, m in masks.items()
        ]
    )
    return fps.select("fp", F.inline(tables)).select("t", "key", "fp")


def _refined(hot: DataFrame, masks: dict[int, int], radius: int) -> tuple[DataFrame, dict[int, int]]:
    """Rows of large buckets in tables that also compare most positions that their table ignored."""
    finer, parts = {}, []
    for t, mask in masks.items():
        free = [i for i in range(BITS) if not mask >> i & 1]
        own = {t * 16 + k + 1: mask | sub for k, sub in enumerate(covering_masks(free, radius))}
        finer |= own
        choices = [
            F.struct(F.lit(n).alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key")) for n, m in own.items()
        ]
        parts.append((t, F.array(*choices)))
    picked = reduce(lambda rest, p: F.when(F.col("t") == p[0], p[1]).otherwise(rest), parts[1:], parts[0][1])
    return hot.select("fp", F.inline(picked)).select("t", "key", "fp"), finer


def _buckets(fps: DataFrame, radius: int, bucket_rows: int) -> DataFrame:
    """(t, key, fp) of all buckets with at least two members, none of them large."""
    masks = dict(enumerate(covering_masks(range(BITS), radius), 1))
    keyed, found = _keyed(fps, masks), []
    for level in range(3):
        sizes = keyed.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n"))
        shared = materialize(sizes.filter("n > 1"), "buckets")
        direct = F.lit(True) if level == 2 else F.col("n") <= bucket_rows
        found.append(keyed.join(shared.filter(direct), ["t", "key"]).select("t", "key", "fp"))
        hot = shared.filter(~direct)
        if hot.isEmpty():
            break
        rows = materialize(keyed.join(hot, ["t", "key"]).select("t", "key", "fp"), "large-buckets")
        keyed, masks = _refined(rows, masks, radius)
    return reduce(DataFrame.unionByName, found)


def _forest(members: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links that join what the links within ``radius`` join, fewer than there are members."""
    rest = members
    while len(rest) > 1:
        waiting, rest = [rest[0]], rest[1:]
        while waiting and len(rest):
            centre = waiting.pop()
            near = np.bitwise_count(rest ^ centre) <= radius
            reached = rest[near]
            if len(reached):
                yield np.full(len(reached), centre), reached
                waiting.extend(reached)
                rest = rest[~near]


def _links_of(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Links within the buckets of sorted rows; the last bucket of a batch waits for the next batch."""
    kept = None

    def links(t: np.ndarray, key: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
        fp = fp.view(np.uint64)
        starts = np.flatnonzero(np.r_[True, (t[1:] != t[:-1]) | (key[1:] != key[:-1])])
        sizes = np.diff(np.r_[starts, len(t)])
        pairs = starts[sizes == 2]
        near = pairs[np.bitwise_count(fp[pairs] ^ fp[pairs + 1]) <= radius]
        left, right = [fp[near]], [fp[near + 1]]
        for start, size in zip(starts[sizes > 2], sizes[sizes > 2]):
            for a, b in _forest(fp[start : start + size], radius):
                left.append(a)
                right.append(b)
        ends = [pa.array(np.concatenate(side).view(np.int64)) for side in (left, right)]
        return pa.RecordBatch.from_arrays(ends, names=["a", "b"])

    for batch in batches:
        now = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
        if kept is not None:
            now = [np.concatenate(pair) for pair in zip(kept, now)]
        t, key, _ = now
        if not len(t):
            continue
        cut = int(np.flatnonzero((t == t[-1]) & (key == key[-1]))[0])
        if cut:
            yield links(*[x[:cut] for x in now])
        kept = [x[cut:] for x in now]
    if kept is not None:
        yield links(*kept)


def fingerprint_links(fps: DataFrame, radius: int = RADIUS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(a, b): links that connect exactly what all links within ``radius`` connect.

    ``fps`` has a column fp of distinct fingerprints. The result is a forest per bucket, not all pairs.
    """
    dealt = _buckets(fps, radius, bucket_rows).repartition("t", "key").sortWithinPartitions("t", "key")
    return dealt.mapInArrow(lambda batches: _links_of(batches, radius), "a bigint, b bigint")


def _labelled(marked: DataFrame, radius: int = RADIUS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Rows with a doc_id and an fp, and the root and component_id of each one's component."""
    marked = materialize(marked, "fingerprints")
    nodes = materialize(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    links = fingerprint_links(nodes.select("fp"), radius, bucket_rows)
    roots = materialize(connected_components(links), "components")
    rooted = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    rooted = materialize(rooted, "rooted")
    named = materialize(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "named")
    labels = materialize(rooted.join(named, "root").select("fp", "root", "component_id"), "labels")
    return marked.join(labels, "fp")


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    radius: int = RADIUS,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """One row per input row: doc_id, fingerprint (16 hex digits), component_id.

    ``component_id`` is the smallest id that a chain of links reaches, the document's own included. A text
    without words (null, empty or blank) has fingerprint zero and links like any other. A null id is ignored
    as a component's name unless all its ids are null. Repeated rows stay and share their component.
    """
    return _labelled(fingerprints(docs, id_col, text_col), radius, bucket_rows).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each component stays, that with the smallest id, a null id being the largest.

    Columns are those of the input, whatever their names. Of a component's rows that share this id one text stays,
    that with the smallest digest, and of rows that repeat both id and text the one with the smallest JSON text. The verdict comes back by id and text, so rows
    of other components stay or go by their own, whatever ids they have in common and even without any.
    """
    found = _labelled(fingerprints(docs, id_col, text_col, digests=True))
    leaders = materialize(
        found.filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
        .groupBy("root", "doc_id", "digest")
        .agg(F.count(F.lit(1)).alias("rows"))
        .groupBy("root")
        .agg(F.min(F.struct("digest", "doc_id", "rows")).alias("leader"))
        .select(
            F.col("leader.doc_id").alias("leader_id"),
            F.col("leader.digest").alias("leader_print"),
            F.col("leader.rows").alias("n_rows"),
        ),
        "leaders",
    )
    packed = packed_rows(docs, id=F.col(f"`{id_col}`"), print=_digest(F.col(f"`{text_col}`")))
    same = F.col("id").eqNullSafe(F.col("leader_id")) & (F.col("print") == F.col("leader_print"))
    kept = packed.join(leaders.drop("n_rows"), same, "left_semi")
    if not leaders.filter("n_rows > 1").isEmpty():
        kept = one_of_each(kept, "id", "print")
    return kept.select("row.*")
