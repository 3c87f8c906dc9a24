"""Chat formatting: speaker roles of transcript lines by a hidden Markov model, then canonical turns.

The hidden states are the roles; a line shows a speaker marker or none, its length, its number of line breaks
and whether it ends with a question mark. Start, transition and emission counts come from lines with known
roles. The most likely roles of a conversation are found by Viterbi's algorithm in its (max, +) matrix form: a
line is a matrix of the best scores from the role before it to its own role, and the product over a run of
lines is again such a matrix. So long conversations need no task of their own: lines form runs of ``FANOUT``
lines, runs form longer runs, up to one matrix per conversation; then the roles at the ends of each run are
chosen from the top down, and the lines of a run last. Each step shuffles by conversation and run.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from riskflow.llm.common import bounded_batches, held_out
from riskflow.operators.ranking import running_totals
from riskflow.session import materialize

# The canonical roles and the names that transcripts give them.
ROLES = ("system", "user", "assistant")
SPEAKERS = {
    "system": ("system", "instruction", "instructions", "context", "developer"),
    "user": ("user", "human", "customer", "question", "prompter", "client", "q", "me"),
    "assistant": ("assistant", "bot", "ai", "gpt", "chatgpt", "model", "answer", "agent", "a"),
}
BEGIN = len(ROLES)  # the state before the first line
STATES = len(ROLES) + 1
FANOUT = 1024
NEVER = -1e9
FEATURES = {"marker": STATES, "length": 16, "breaks": 4, "question": 2}
# Counts that a marker has before any line is seen: it nearly always tells the truth.
MARKER_PRIOR, OTHER_PRIOR, WRONG_PRIOR = 10.0, 10.0, 0.01
_NAMES = "|".join(sorted((name for names in SPEAKERS.values() for name in names), key=lambda n: (-len(n), n)))
_MARKED = rf"(?:(?:#+\s*|\*\*|>\s*)?({_NAMES})(?:\s*\d+)?(?:\*\*)?\s*:(?:\*\*)?|(?:<\|(?:im_start\|>)?|\[)({_NAMES})(?:\|>|\]|\b(?=\s*\n))|#+\s*({_NAMES})\s*\n)"
MARKER = rf"(?i)^\s*{_MARKED}\s*"
NEXT_SPEAKER = rf"(?i)\n(?=[ \t]*{_MARKED})"  # the line end before a marked line


@dataclass(frozen=True)
class Model:
    """Log-probabilities: ``steps[before, role]`` with ``BEGIN`` as a role before, ``shows[feature][role, value]``."""

    steps: np.ndarray
    shows: dict[str, np.ndarray]

    def matrix(self, observed: tuple[int, ...]) -> np.ndarray:
        """Best scores from each state before a line to each state at it."""
        out = np.full((STATES, STATES), NEVER)
        emission = sum(self.shows[name][:, value] for name, value in zip(FEATURES, observed))
        out[:, :BEGIN] = self.steps + emission
        return out


def _marked_role(text: Column) -> Column:
    """The number of the role that a marker names, or the number of roles for no marker."""
    said = F.lower(F.concat_ws("", *[F.regexp_extract(text, MARKER, group) for group in (1, 2, 3)]))
    found = F.lit(BEGIN)
    for number, role in enumerate(ROLES):
        found = F.when(said.isin(*SPEAKERS[role]), number).otherwise(found)
    return found


def role_number(role: Column) -> Column:
    """The number of a given role under any of its names; null for others."""
    found = F.lit(None).cast("int")
    for number, name in enumerate(ROLES):
        found = F.when(F.lower(F.trim(role)).isin(*SPEAKERS[name]), number).otherwise(found)
    return found


def observed_lines(
    lines: DataFrame, conv_col: str = "conv_id", order_col: str = "turn", text_col: str = "text", role_col: str | None = "role"
) -> tuple[DataFrame, DataFrame]:
    """The parts of all texts, and their places without text: what is shown there, and a number in the conversation.

    A text is a transcript of its own: it is cut before each line that starts with a speaker marker. A line without
    a conversation or without a number is a conversation of its own. Numbers are running totals by turn, row and
    part, so lines that share a turn are told apart, and any number of them may.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    given = F.col(f"`{role_col}`") if role_col else F.lit(None).cast("string")
    conv, at = F.col(f"`{conv_col}`"), F.col(f"`{order_col}`")
    alone = conv.isNull() | at.isNull()
    row = F.monotonically_increasing_id()
    rows = lines.select(conv.alias("conv"), at.alias("at"), given.alias("given"), alone.alias("alone"), row.alias("row"), text.alias("whole"))
    cut = rows.select("conv", "at", "given", "alone", "row", F.posexplode(F.split("whole", NEXT_SPEAKER)).alias("part", "text"))
    text = F.col("text")
    parts = materialize(
        cut.select(
            "*",
            _marked_role(text).alias("marker"),
            F.least(F.floor(F.log2(F.length(text) + 1)), F.lit(FEATURES["length"] - 1)).cast("int").alias("length"),
            F.least(F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))), F.lit(3)).cast("int").alias("breaks"),
            F.rtrim(text).endswith("?").cast("int").alias("question"),
        ),
        "parts",
    )
    own = F.when(F.col("alone"), F.concat(F.lit("row "), F.col("row"))).otherwise(F.concat(F.lit("conversation "), F.col("conv")))
    taught = ~F.col("alone") & ~held_out(F.col("conv")) & (F.col("part") == 0)
    role = F.when(taught, role_number(F.col("given")))
    keys = parts.select(
        own.alias("conv"), F.col("at").alias("turn"), "row", "part", role.alias("role"), *FEATURES, F.lit(1).alias("one")
    )
    numbered = running_totals(keys, [F.asc("turn"), F.asc("row"), F.asc("part")], "one", ["conv"], "at")
    run = F.floor(F.col("at") / FANOUT).cast("bigint").alias("run")
    places = numbered.select("conv", run, F.col("at").cast("bigint").alias("at"), "row", "part", "role", *FEATURES)
    return parts, materialize(places, "places")


def train(places: DataFrame) -> Model:
    """Counts over all lines with a known role outside the held-out third of conversations.

    Neighbours are found within runs, and across runs through the first and last role of each.
    """
    known = places.filter("role IS NOT NULL")
    before = F.lag("role").over(Window.partitionBy("conv", "run").orderBy("at"))
    inner = known.select("role", before.alias("before")).filter("before IS NOT NULL")
    runs = known.groupBy("conv", "run").agg(F.min_by("role", "at").alias("role"), F.max_by("role", "at").alias("last"))
    earlier = F.coalesce(F.lag("last").over(Window.partitionBy("conv").orderBy("run")), F.lit(BEGIN))
    steps = inner.unionByName(runs.select("role", earlier.alias("before")))
    pairs = steps.groupBy("before", "role").agg(F.count(F.lit(1)).alias("n")).collect()
    values = F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).alias("value")) for f in FEATURES]))
    shown = (
        known.select("role", values.alias("seen"))
        .groupBy("role", "seen.feature", "seen.value")
        .agg(F.count(F.lit(1)).alias("n"))
        .collect()
    )
    moves = np.ones((STATES, BEGIN))
    for r in pairs:
        moves[r.before, r.role] += r.n
    counts = {name: np.ones((BEGIN, size)) for name, size in FEATURES.items()}
    counts["marker"] = np.full((BEGIN, STATES), WRONG_PRIOR) + np.eye(BEGIN, STATES) * MARKER_PRIOR
    counts["marker"][:, BEGIN] = OTHER_PRIOR
    for r in shown:
        counts[r.feature][r.role, r.value] += r.n
    shows = {name: np.log(c / c.sum(axis=1, keepdims=True)) for name, c in counts.items()}
    return Model(np.log(moves / moves.sum(axis=1, keepdims=True)), shows)


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a[:, :, None] + b[None, :, :]).max(axis=1)


def _path(matrices: list[np.ndarray], before: int, end: int | None) -> list[int]:
    """The best states of a run after ``before``; the last is ``end`` if that is given."""
    scores, back = matrices[0][before], []
    for m in matrices[1:]:
        both = scores[:, None] + m
        back.append(both.argmax(axis=0))
        scores = both.max(axis=0)
    state = int(scores.argmax()) if end is None else end
    path = [state]
    for choice in reversed(back):
        state = int(choice[state])
        path.append(state)
    return path[::-1]


def _runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[list[tuple]]:
    """The rows of each run; rows come sorted by their first ``keys`` columns."""
    run: list[tuple] = []
    for batch in batches:
        for row in zip(*[column.to_pylist() for column in batch.columns]):
            if run and run[-1][:keys] != row[:keys]:
                yield run
                run = []
            run.append(row)
    if run:
        yield run


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    waiting: list[tuple] = []
    for row in rows:
        waiting.append(row)
        if len(waiting) == 1024:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*waiting), schema)], schema=schema)
            waiting = []
    if waiting:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*waiting), schema)], schema=schema)


def _summaries(nodes: DataFrame, matrix_of) -> DataFrame:
    """(conv, at, m): the product over each run. ``nodes`` has conv, run, at and what ``matrix_of`` reads."""
    dealt = nodes.repartition("conv", "run").sortWithinPartitions("conv", "run", "at")

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for run in _runs(batches, 2):
                total = matrix_of(run[0][3:])
                for row in run[1:]:
                    total = _product(total, matrix_of(row[3:]))
                yield run[0][0], run[0][1], total.ravel().tolist()

        return _batches(rows(), schema)

    schema = pa.schema([("conv", pa.string()), ("at", pa.int64()), ("m", pa.list_(pa.float64()))])
    return materialize(dealt.mapInArrow(compute, "conv string, at bigint, m array<double>"), "runs")


def _of_list(values: tuple) -> np.ndarray:
    return np.array(values[0]).reshape(STATES, STATES)


def decode(places: DataFrame, model: Model) -> DataFrame:
    """row, part, role and opens (whether a turn starts) of each place."""
    bounded_batches(places.sparkSession)
    levels = [_summaries(places.select("conv", "run", "at", *FEATURES), model.matrix)]
    while True:
        # ``at`` of a level numbers its runs; a run of runs is the next number up.
        grouped = levels[-1].select("conv", F.floor(F.col("at") / FANOUT).cast("bigint").alias("run"), "at", "m")
        if not levels[-1].agg(F.max("at")).head()[0]:
            break
        levels.append(_summaries(grouped, _of_list))
    # The top level has one run per conversation. Its ends are free; every other run gets both ends from above.
    chosen = levels[-1].select("conv", "at", F.lit(BEGIN).alias("before"), F.lit(None).cast("int").alias("end"))
    for level in reversed(levels[:-1]):
        chosen = _ends_of_parts(level, chosen)
    lines = places.join(chosen.select("conv", F.col("at").alias("run"), "before", "end"), ["conv", "run"])
    return _roles(lines.select("conv", "run", "at", "before", "end", *FEATURES, "row", "part"), model)


def _ends_of_parts(level: DataFrame, chosen: DataFrame) -> DataFrame:
    """For the parts of each chosen run the states before them and at their ends."""
    parts = level.select("conv", F.floor(F.col("at") / FANOUT).cast("bigint").alias("run"), "at", "m")
    joined = parts.join(chosen.select("conv", F.col("at").alias("run"), "before", "end"), ["conv", "run"])
    dealt = joined.select("conv", "run", "at", "m", "before", "end").repartition("conv", "run")
    schema = pa.schema([("conv", pa.string()), ("at", pa.int64()), ("before", pa.int32()), ("end", pa.int32())])

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for run in _runs(batches, 2):
                before = run[0][4]
                for row, state in zip(run, _path([_of_list(row[3:4]) for row in run], before, run[0][5])):
                    yield row[0], row[2], before, state
                    before = state

        return _batches(rows(), schema)

    sorted_ = dealt.sortWithinPartitions("conv", "run", "at")
    return materialize(sorted_.mapInArrow(compute, "conv string, at bigint, before int, end int"), "run-ends")


def _roles(lines: DataFrame, model: Model) -> DataFrame:
    dealt = lines.repartition("conv", "run").sortWithinPartitions("conv", "run", "at")
    types = [pa.int64(), pa.int32(), pa.string(), pa.bool_()]
    schema = pa.schema(list(zip(["row", "part", "role", "opens"], types)))
    n = 5 + len(FEATURES)

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for run in _runs(batches, 2):
                before = run[0][3]
                for row, state in zip(run, _path([model.matrix(row[5:n]) for row in run], before, run[0][4])):
                    yield row[n], row[n + 1], ROLES[state], state != before or row[5] != BEGIN
                    before = state

        return _batches(rows(), schema)

    return dealt.mapInArrow(compute, "row bigint, part int, role string, opens boolean")


def format_chat(
    lines: DataFrame,
    conv_col: str = "conv_id",
    order_col: str = "turn",
    text_col: str = "text",
    role_col: str | None = "role",
    model: Model | None = None,
) -> DataFrame:
    """One row per line and speaker in it: conv_id, turn, part, held_out, given_role, role, opens, rendered.

    A text in which several marked speakers follow each other gives a part for each, numbered from 0; other texts
    are one part. ``role`` comes from the lines alone; ``given_role`` is what the input says of the whole line, which
    only first parts in conversations that are not held out teach the model. ``rendered`` is the part without its
    marker, after a header where a turn opens; the parts of a conversation in order are its canonical form. A null
    text is empty. A line without a conversation or number stands alone. Lines that share both, repeated ones
    included, all stay and follow each other in one order. Keys may be of any type that has an order. Other columns
    are ignored, whatever their names; an empty table gives an empty result.
    """
    parts, places = observed_lines(lines, conv_col, order_col, text_col, role_col)
    decoded = decode(places, model or train(places))
    header = F.when(
        F.col("opens"), F.concat(F.lit("<|"), F.col("role"), F.lit("|>\n"))
    ).otherwise(F.lit(""))
    body = F.trim(F.regexp_replace("text", MARKER, ""))
    return parts.join(decoded, ["row", "part"]).select(
        F.col("conv").alias("conv_id"),
        F.col("at").alias("turn"),
        "part",
        held_out(F.col("conv")).alias("held_out"),
        F.col("given").alias("given_role"),
        "role",
        "opens",
        F.concat(header, body, F.lit("\n")).alias("rendered"),
    )
