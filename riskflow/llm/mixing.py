"""Mixing sources to target weights by Pfair scheduling.

A source's documents form blocks of ``block_docs``. One block is placed per slot. With the target weight w the
k-th block of a source (from 0) is released at slot floor(k/w) and due by slot ceil((k+1)/w); of the released
blocks the one with the earliest deadline goes next. Weights are rounded to multiples of 1/period, which
makes the schedule repeat after ``period`` slots: it is worked out once for that many slots, and the slot of
any block follows from its number. At every slot each source has placed its share within less than one block.

Every document gets a place. A source that has run out leaves its slots empty, so the others keep their
proportions; sources without a weight come after all others. Documents are numbered within their source by a
hash of their ids: a source is split into about as many shards as a shard has rows, shards are numbered in
parallel, and an offset per shard makes the numbers run on. So no task holds a large source.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Mapping

from pyspark.sql import DataFrame, Window, functions as F

from riskflow.llm.common import packed_rows, text_rows
from riskflow.session import materialize

BLOCK_DOCS = 8
PERIOD = 2000
STRETCH = 1 << 14
CROWD = 1000  # different rows with one id and source above which they are spread
MICROS = "yyyy-MM-dd HH:mm:ss.SSSSSS"  # rows are told apart by all that a timestamp holds
TEMPERATURE = 0.5  # target weights grow with this power of a source's size unless they are given


def shares(weights: Mapping[str | None, float], period: int = PERIOD) -> dict[str | None, int]:
    """Slots per period of each source with a positive weight: at least one, in all exactly the period.

    The period grows to 20 slots per source where there are many sources.
    """
    positive = {s: float(w) for s, w in weights.items() if w > 0 and math.isfinite(w)}
    if not positive:
        return {}
    period = max(period, 20 * len(positive))
    total = sum(positive.values())
    spare = period - len(positive)
    exact = {s: spare * w / total for s, w in positive.items()}
    slots = {s: 1 + math.floor(x) for s, x in exact.items()}
    by_rest = sorted(exact, key=lambda s: (math.floor(exact[s]) - exact[s], str(s)))
    for s in by_rest[: period - sum(slots.values())]:
        slots[s] += 1
    return slots


def schedule(slots: Mapping[str | None, int]) -> dict[str | None, list[int]]:
    """The slots of each source within one period, by earliest deadline first."""
    period = sum(slots.values())
    jobs = sorted(
        (k * period // c, -(-(k + 1) * period // c), str(s), s) for s, c in slots.items() for k in range(c)
    )
    placed: dict[str | None, list[int]] = {s: [] for s in slots}
    ready: list[tuple[int, str, int, str | None]] = []
    at = 0
    for slot in range(period):
        while at < len(jobs) and jobs[at][0] <= slot:
            _, due, name, source = jobs[at]
            heapq.heappush(ready, (due, name, at, source))
            at += 1
        placed[heapq.heappop(ready)[3]].append(slot)
    return placed


def target_weights(docs: DataFrame, source_col: str = "source", temperature: float = TEMPERATURE) -> dict[str | None, float]:
    """Weights that grow with a power of the sizes; one row per source comes to the driver."""
    sizes = text_rows(docs, source_col).groupBy(F.col(source_col).alias("source")).agg(F.count(F.lit(1)).alias("n"))
    return {r.source: r.n**temperature for r in sizes.collect()}


def _numbered(units: DataFrame) -> DataFrame:
    """``units`` with _from, the rows of their source before them, in the order of a hash within shards.

    The hash is that of the id, so that each document has one place whatever its text; units that crowd under one
    id or none are spread by all that they hold.
    """
    sized = units.groupBy("_source").agg(F.sum("_copies").alias("_rows"))
    sized = materialize(sized.select("_source", F.ceil(F.sqrt("_rows")).cast("int").alias("_shards")), "sources")
    keyed = units.join(
        sized.withColumnRenamed("_source", "_sized"), F.col("_source").eqNullSafe(F.col("_sized"))
    ).drop("_sized")
    crowded = units.groupBy("_id", "_source").agg(F.count(F.lit(1)).alias("_units")).filter(F.col("_units") > CROWD)
    crowded = materialize(crowded.select(F.col("_id").alias("_by"), F.col("_source").alias("_with"), "_units"), "crowded")
    drawn = F.when(F.col("_units").isNull(), F.xxhash64("_id")).otherwise(F.xxhash64("_id", "_print"))
    same = F.col("_id").eqNullSafe(F.col("_by")) & F.col("_source").eqNullSafe(F.col("_with"))
    keyed = keyed.join(crowded, same, "left").withColumn("_draw", drawn)
    sharded = keyed.withColumn("_shard", F.pmod(F.col("_draw"), F.col("_shards").cast("bigint")).cast("int"))
    before = Window.partitionBy("_source").orderBy("_shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = materialize(
        sharded.groupBy("_source", "_shard")
        .agg(F.sum("_copies").alias("_size"))
        .select(
            F.col("_source").alias("_of"),
            F.col("_shard").alias("_in"),
            F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"),
        ),
        "offsets",
    )
    order = Window.partitionBy("_source", "_shard").orderBy("_draw", "_id", "_print")
    within = F.coalesce(F.sum("_copies").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return (
        sharded.withColumn("_within", within)
        .join(offsets, F.col("_source").eqNullSafe(F.col("_of")) & (F.col("_shard") == F.col("_in")))
        .withColumn("_from", F.col("_offset") + F.col("_within"))
        .select("_id", "_source", "_print", "_copies", "_from")
    )


def _placed(
    units: DataFrame,
    source_kind: str,
    weights: Mapping[str | None, float],
    block_docs: int,
    period: int,
) -> DataFrame:
    """(_id, _source, _print, _copies, _start, block, place, slot): a row for every copy of every unit."""
    units = materialize(units, "units")
    slots = shares(weights, period)
    length = sum(slots.values())
    pattern = units.sparkSession.createDataFrame(
        [(s, slots[s], at) for s, at in schedule(slots).items()] or [(None, 1, [0])][:0],
        f"_mixed {source_kind}, _per_period int, _slots array<int>",
    )
    # Copies are counted out in stretches, so that no list grows with their number.
    stretch = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_copies") - 1, F.lit(STRETCH).cast("bigint")))
    ends = F.least(F.col("_start") + (STRETCH - 1), F.col("_copies") - 1)
    copies = _numbered(units).withColumn("_start", stretch).withColumn("_copy", F.explode(F.sequence("_start", ends)))
    n = F.col("_from") + F.col("_copy")
    block = F.floor(n / block_docs)
    slot = F.floor(block / F.col("_per_period")) * length + F.get(
        "_slots", F.pmod(block, F.col("_per_period").cast("bigint")).cast("int")
    )
    # One row per source with a weight: the caller's own list, or one as long as the number of sources.
    return copies.join(pattern, F.col("_source").eqNullSafe(F.col("_mixed")), "left").select(
        *("_id", "_source", "_print", "_copies", "_start"),
        block.alias("block"),
        F.pmod(n, F.lit(block_docs)).cast("int").alias("place"),
        slot.alias("slot"),
    )


def mix_sources(
    docs: DataFrame,
    weights: Mapping[str | None, float] | None = None,
    id_col: str = "doc_id",
    source_col: str = "source",
    block_docs: int = BLOCK_DOCS,
    period: int = PERIOD,
) -> DataFrame:
    """One row per input row: doc_id, source, block, place and slot.

    Order by slot, then place, to read the mix. ``weights`` default to ``target_weights``. A null source is a
    source of its own. Rows without an id and repeated ids each get a place: rows that agree in id and source are
    counted first, so a third of all rows may do so. A slot is null for sources without a weight: they come last.
    Other columns are ignored. An empty table gives an empty result.
    """
    chosen = target_weights(docs, source_col) if weights is None else weights
    units = (
        text_rows(docs, id_col, source_col)
        .select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{source_col}`").alias("_source"), F.lit("").alias("_print"))
        .groupBy("_id", "_source", "_print")
        .agg(F.count(F.lit(1)).alias("_copies"))
    )
    kind = docs.schema[source_col].dataType.simpleString()
    placed = _placed(units, kind, chosen, block_docs, period)
    return placed.select(F.col("_id").alias("doc_id"), F.col("_source").alias("source"), "block", "place", "slot")


def in_mixed_order(docs: DataFrame, weights: Mapping[str | None, float] | None = None) -> DataFrame:
    """All documents, with all their columns, sorted into the mix over consecutive partitions.

    Files written from the result hold the mix in the order of their names, and each of them a run of it, so
    whoever reads a file sees the target weights. Rows that agree in all columns are counted and move as one. An
    empty table gives an empty result.
    """
    chosen = target_weights(docs) if weights is None else weights
    whole = F.to_json(F.struct("*"), {"timestampFormat": MICROS, "timestampNTZFormat": MICROS})
    packed = packed_rows(docs, _id=F.col("doc_id"), _source=F.col("source"), _print=F.sha2(whole, 256))
    counted = F.count(F.lit(1)).alias("_copies")
    units = packed.groupBy("_print").agg(F.any_value("_id").alias("_id"), F.any_value("_source").alias("_source"), counted)
    kind = docs.schema["source"].dataType.simpleString()
    placed = materialize(_placed(units, kind, chosen, BLOCK_DOCS, PERIOD), "places")
    order = [F.asc_nulls_last("slot"), F.asc("place"), F.asc("block")]
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Ranges are drawn from the places alone; drawn from whole rows, these would be joined and read once more for it.
    dealt = placed.repartitionByRange(parts, *order).withColumn("_file", F.spark_partition_id())
    places = dealt.select("_print", "_start", F.col("_copies") > STRETCH, "block", "place", "slot", "_file")
    places = places.toDF("_print", "_start", "_crowd", "block", "place", "slot", "_file")
    found = packed.groupBy("_print").agg(F.any_value("row").alias("row"), counted)
    # Rows meet their places where they were counted; only those with more copies than a stretch holds move again.
    kept = ["row", "block", "place", "slot", "_file"]
    mixed = found.filter(F.col("_copies") <= STRETCH).join(places.filter("NOT _crowd"), "_print").select(*kept)
    if not placed.filter(F.col("_copies") > STRETCH).isEmpty():
        starts = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_copies") - 1, F.lit(STRETCH).cast("bigint")))
        crowds = found.filter(F.col("_copies") > STRETCH).withColumn("_start", starts)
        mixed = mixed.unionByName(crowds.join(places.filter("_crowd"), ["_print", "_start"]).select(*kept))
    mixed = mixed.repartitionById(parts, "_file")
    return mixed.sortWithinPartitions(*order).select("row.*")
