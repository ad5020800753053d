"""Transcript parsing: a hidden Markov model over lines recovers who speaks.

Every line of a transcript has a hidden state: a role, and whether the line begins a turn or
goes on with one. A line shows whose marker it starts with, if any, and features of its own
(length, a closing question mark, a blank line before it, list and code marks, whether it is
the first); having no marker says one thing where the transcript uses markers and another
where it has none. Chances are counted over all labelled transcripts; Viterbi's path over a
transcript's lines gives its turns, which are rendered in one canonical form.

A transcript comes in parts, in order. ``PART_BLOCK`` parts are a block, counted by rank in
the order and not by the parts' own numbers, which may be null or repeated; ranks come from
a sort by range, so no task numbers a transcript alone. A block is one row of the work: its
lines reduce to the best score from each state before it to each state
at its end, these small matrices are combined in a tree of ``FAN`` neighbours a node, the best
states come back down the tree, and each block then traces its own path between the states it was given. So the path is
that of the whole transcript, however long it is, and no task holds all its text.

Defined results: a null or empty text is one empty line; parts that share a number are
ordered by their text; a null part comes first; rows without a conversation id are one
conversation; null or unknown roles teach nothing; repeated rows are parts each; other
columns are ignored. Without labelled rows the markers alone decide. An empty table gives
an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nightfolio.llm.common import stored

ROLES = ("system", "user", "assistant")
#: States: each role beginning a turn, then each role going on.
STATES = 2 * len(ROLES)
PART_BLOCK = 64
#: Blocks, or spans of them, that one group of the tree combines.
FAN = 64
#: The names that speaker markers use.
NAMES = {
    "system": "system|instruction|instructions|context",
    "user": "user|human|prompter|question|q|me",
    "assistant": "assistant|ai|bot|chatbot|gpt|model|answer|a|response",
}
_MARK = re.compile(
    r"\s{0,8}(?:"
    + "|".join(
        rf"(?:<\|(?:{names})\|>|\[(?:{names})\]:?|(?:[#*>]{{1,4}} ?)?(?:{names})(?: ?\*{{1,2}})? ?[:>]\s?|#{{1,4}} ?(?:{names})\s*$)(?P<{role}>)"
        for role, names in NAMES.items()
    )
    + ")",
    re.IGNORECASE,
)
FEATURES = ("marker", "length", "asks", "blank_before", "list_or_code", "first")
VALUES = (5, 6, 2, 2, 2, 2)
WEIGHT = sum(VALUES)
_OFFSETS = np.cumsum((0, *VALUES[:-1]))


def marker_of(line: str) -> tuple[int, int]:
    """Which role's marker a line starts with, as its place plus one, and where it ends."""
    match = _MARK.match(line)
    return (ROLES.index(match.lastgroup) + 1, match.end()) if match else (0, 0)


def observed(lines: list[str], first: bool, marked: bool, blank: bool) -> np.ndarray:
    """The features of lines, as rows of places in the table of chances.

    ``marked`` says whether the transcript has markers, ``blank`` what stands before.
    """
    out = np.empty((len(lines), len(VALUES)), np.int64)
    for i, line in enumerate(lines):
        plain = line.strip()
        size = len(plain)
        out[i] = (
            marker_of(line)[0] if marked else len(ROLES) + 1,
            0 if not size else min(5, 1 + size.bit_length() // 3),
            plain.endswith("?"),
            blank,
            plain.startswith(("-", "* ", "```", "1.", "|")),
            first and i == 0,
        )
        blank = not size
    return out + _OFFSETS


def _lines(text: str | None) -> list[str]:
    return (text or "").split("\n")


def _teach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of features by state, of steps between states, and of first states."""
    width = STATES * (WEIGHT + STATES + 1)
    total = np.zeros(width, np.int64)
    emitted = total[: STATES * WEIGHT].reshape(STATES, WEIGHT)
    steps = total[STATES * WEIGHT : STATES * (WEIGHT + STATES)].reshape(STATES, STATES)
    starts = total[STATES * (WEIGHT + STATES) :]
    for batch in batches:
        for is_first, marked, blank, parts in zip(*(c.to_pylist() for c in batch.columns)):
            before = None
            for place, part in enumerate(parts):
                lines = _lines(part["text"])
                first = is_first and place == 0
                seen = observed(lines, first, marked, blank)
                blank = not lines[-1].strip()
                if part["role"] not in ROLES:
                    before = None
                    continue
                role = ROLES.index(part["role"])
                states = np.full(len(lines), role + len(ROLES))
                states[0] = role
                np.add.at(emitted, (np.repeat(states, len(VALUES)), seen.ravel()), 1)
                np.add.at(steps, (states[:-1], states[1:]), 1)
                if before is not None:
                    steps[before, role] += 1
                if first:
                    starts[role] += 1
                before = states[-1]
    yield pa.record_batch(
        [pa.array(np.arange(width)), pa.array(total)], ["cell", "n"]
    )


class Chances:
    """Logarithms of the model's chances, from counts."""

    def __init__(self, counts: np.ndarray):
        emitted = counts[: STATES * WEIGHT].reshape(STATES, WEIGHT) + 0.5
        # A marker speaks for its role's beginning until counts say otherwise.
        for role in range(len(ROLES)):
            emitted[role, role + 1] += 20
            emitted[role + len(ROLES), 0] += 20
        steps = counts[STATES * WEIGHT : STATES * (WEIGHT + STATES)].reshape(STATES, STATES) + 0.1
        # A line can only go on with the role of the line before.
        allowed = np.ones((STATES, STATES), bool)
        for role in range(len(ROLES)):
            onward = [i for i in range(STATES) if i % len(ROLES) != role]
            allowed[onward, role + len(ROLES)] = False
        starts = counts[STATES * (WEIGHT + STATES) :] + 0.1
        starts[len(ROLES) :] = 0
        self.emit = emitted.astype(float)
        for offset, size in zip(_OFFSETS, VALUES):
            part = self.emit[:, offset : offset + size]
            self.emit[:, offset : offset + size] = np.log(part / part.sum(axis=1, keepdims=True))
        with np.errstate(divide="ignore"):
            steps = np.where(allowed, steps, 0.0)
            self.step = np.log(steps / steps.sum(axis=1, keepdims=True))
            self.start = np.log(starts / starts.sum())

    def scores(self, seen: np.ndarray) -> np.ndarray:
        return self.emit[:, seen].sum(axis=2).T


def spans_best(model: Chances, scores: np.ndarray) -> np.ndarray:
    """The best score from each state before some lines to each state at their end."""
    best = model.step + scores[0]
    for line in scores[1:]:
        best = (best[:, :, None] + model.step[None]).max(axis=1) + line
    return best


def path(model: Chances, scores: np.ndarray, entry: np.ndarray, last: int | None) -> np.ndarray:
    """Viterbi's states of some lines; ``entry`` scores each state of the first line."""
    best = entry + scores[0]
    back = np.empty(scores.shape, np.int64)
    for i, line in enumerate(scores[1:], 1):
        through = best[:, None] + model.step
        back[i] = through.argmax(axis=0)
        best = through.max(axis=0) + line
    states = np.empty(len(scores), np.int64)
    states[-1] = best.argmax() if last is None else last
    for i in range(len(scores) - 1, 0, -1):
        states[i - 1] = back[i, states[i]]
    return states


def render(role: str, text: str) -> str:
    return f"<|{role}|>\n{text}<|end|>\n"


def _block_lines(parts: list[dict]) -> list[str]:
    return [line for part in parts for line in _lines(part["text"])]


def _flags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whether a block has a speaker marker, and whether its last line is blank."""
    for batch in batches:
        marked, ends_blank = [], []
        for parts in batch.column(2).to_pylist():
            lines = _block_lines(parts)
            marked.append(any(marker_of(line)[0] for line in lines))
            ends_blank.append(not lines[-1].strip())
        yield pa.record_batch(
            [batch.column(0), batch.column(1), pa.array(marked), pa.array(ends_blank)],
            ["conv_id", "block", "has_marker", "ends_blank"],
        )


def _same(a: DataFrame, b: DataFrame) -> Column:
    """Null ids are one conversation, so keys are compared null-safe."""
    return a["conv_id"].eqNullSafe(b["conv_id"]) & (a["block"] == b["block"])


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the task's number and, from 0 for each conversation in it, the rows' places."""
    task = TaskContext.get().partitionId()
    last, n = object(), 0
    for batch in batches:
        places = []
        for conv in batch.column(0).to_pylist():
            last, n = conv, n + 1 if conv == last else 0
            places.append(n)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array([task] * len(places), pa.int64()), pa.array(places, pa.int64())],
            names=[*batch.schema.names, "task", "place"],
        )


def _ranked(rows: DataFrame, *extra: str) -> DataFrame:
    """Parts with their rank in the conversation, by number, text and ``extra``.

    The range of a task ends at a number or at a text's beginning; only parts of one
    conversation, number and beginning stay together, and their sort can spill.
    """
    parts = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("part").cast("long").alias("part"),
        "text",
        *extra,
    )
    shape = ", ".join(f"{c} {t}" for c, t in parts.dtypes) + ", task long, place long"
    places = stored(
        parts.repartitionByRange("conv_id", "part", F.substring("text", 1, 256))
        .sortWithinPartitions("conv_id", "part", "text", *extra)
        .mapInArrow(_numbered, shape),
        "parts",
    )
    before = Window.partitionBy("conv_id").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    # A task goes on with one conversation at most, so there are no more rows than tasks.
    offsets = (
        places.groupBy("conv_id", "task")
        .agg((F.max("place") + 1).alias("n"))
        .select(
            F.col("conv_id").alias("conv"),
            F.col("task").alias("in_task"),
            F.sum("n").over(before).alias("before"),
        )
        .filter("before IS NOT NULL")
    )
    same = F.col("conv_id").eqNullSafe(F.col("conv")) & (F.col("task") == F.col("in_task"))
    return places.join(F.broadcast(offsets), same, "left").select(
        "conv_id",
        "part",
        "text",
        *extra,
        (F.col("place") + F.coalesce("before", F.lit(0))).alias("rank"),
    )


def _blocks(rows: DataFrame, *extra: str) -> DataFrame:
    """Parts in blocks of neighbouring ranks, in order, with what a block needs to know
    of its transcript: whether it is the first, whether there are markers, what is before."""
    blocks = stored(
        _ranked(rows, *extra)
        .select(
            "conv_id",
            F.floor(F.col("rank") / PART_BLOCK).cast("long").alias("block"),
            F.struct("part", "text", *extra).alias("p"),
        )
        .groupBy("conv_id", "block")
        .agg(F.array_sort(F.collect_list("p")).alias("parts")),
        "transcripts",
    )
    flags = blocks.mapInArrow(
        _flags, "conv_id long, block long, has_marker boolean, ends_blank boolean"
    )
    flags = stored(flags, "flags")
    whole = flags.groupBy("conv_id").agg(
        F.max("has_marker").alias("marked"), F.count("*").alias("n")
    )
    before = flags.select(
        F.col("conv_id").alias("before"), (F.col("block") + 1).alias("next"), "ends_blank"
    )
    own = flags.select("conv_id", "block").join(
        before, F.col("conv_id").eqNullSafe(F.col("before")) & (F.col("block") == F.col("next")), "left"
    )
    known = own.join(whole, own["conv_id"].eqNullSafe(whole["conv_id"])).select(
        own["conv_id"], "block", F.col("ends_blank").alias("blank"), "marked", "n"
    )
    return blocks.join(known, _same(blocks, known)).select(
        blocks["conv_id"],
        blocks["block"],
        (blocks["block"] == 0).alias("is_first"),
        "marked",
        F.coalesce("blank", F.lit(False)).alias("blank"),
        "parts",
        "n",
    )


def learned(rows: DataFrame) -> Chances:
    """The chances counted over all rows that have a role."""
    counts = (
        _blocks(rows, "role")
        .select("is_first", "marked", "blank", "parts")
        .mapInArrow(_teach, "cell long, n long")
        .groupBy("cell")
        .agg(F.sum("n").alias("n"))
        .collect()
    )
    table = np.zeros(STATES * (WEIGHT + STATES + 1))
    for r in counts:
        table[r["cell"]] = r["n"]
    return Chances(table)


def _block_scores(model: Chances, batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    columns = (batch.column(name).to_pylist() for name in ("is_first", "marked", "blank", "parts"))
    for first, marked, blank, parts in zip(*columns):
        yield model.scores(observed(_block_lines(parts), first, marked, blank))


def _summaries(model: Chances):
    """The best scores from each state before a block to each at its end; a first block is
    entered by the chances of first states, whatever is said to be before it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best = []
            for scores, first in zip(_block_scores(model, batch), batch.column("is_first").to_pylist()):
                if first:
                    end = model.start + scores[0]
                    for line in scores[1:]:
                        end = (end[:, None] + model.step).max(axis=0) + line
                    span = np.tile(end, (STATES, 1))
                else:
                    span = spans_best(model, scores)
                best.append(span.ravel().tolist())
            yield pa.record_batch(
                [batch.column(0), batch.column(1), pa.array(best, pa.list_(pa.float64()))],
                ["conv_id", "place", "span"],
            )

    return run


def _spans(frame: pd.DataFrame) -> list[np.ndarray]:
    return [np.reshape(span, (STATES, STATES)) for span in frame["span"]]


def _combined(frame: pd.DataFrame) -> pd.DataFrame:
    """Neighbouring spans as one."""
    frame = frame.sort_values("place")
    first, *rest = _spans(frame)
    for span in rest:
        first = (first[:, :, None] + span[None]).max(axis=1)
    return pd.DataFrame(
        {
            "conv_id": frame["conv_id"].to_numpy()[:1],
            "place": frame["place"].to_numpy()[:1] // FAN,
            "span": [first.ravel().tolist()],
        }
    )


def _passed_down(frame: pd.DataFrame) -> pd.DataFrame:
    """For neighbouring spans, the scores before each and its last state, given the scores before
    the first and the last state of the last, which is the best one where none is given."""
    frame = frame.sort_values("place")
    spans, before = _spans(frame), frame["before"].iloc[0]
    befores = [np.zeros(STATES) if before is None else np.array(before)]
    for span in spans:
        befores.append((befores[-1][:, None] + span).max(axis=0))
    last = frame["last"].iloc[0]
    lasts = [int(befores[-1].argmax()) if last < 0 else int(last)]
    for end, span in zip(befores[-2:0:-1], spans[:0:-1]):
        lasts.append(int((end + span[:, lasts[-1]]).argmax()))
    return pd.DataFrame(
        {
            "conv_id": frame["conv_id"].to_numpy(),
            "place": frame["place"].to_numpy(),
            "before": [b.tolist() for b in befores[:-1]],
            "last": lasts[::-1],
        }
    )


def _entered(spans: DataFrame) -> DataFrame:
    """``before`` and ``last`` for each span, through a tree of ``FAN`` neighbours a node.

    No group has more than ``FAN`` rows, however many blocks a transcript has.
    """
    levels = [stored(spans, "spans")]
    most = levels[0].agg(F.max("place")).first()[0] or 0
    up = F.floor(F.col("place") / FAN).cast("long")
    while most >= FAN:
        grouped = levels[-1].groupBy("conv_id", up.alias("up"))
        levels.append(
            stored(grouped.applyInPandas(_combined, "conv_id long, place long, span array<double>"), "spans")
        )
        most //= FAN
    shape = "conv_id long, place long, before array<double>, last int"
    found = None
    for level in reversed(levels):
        if found is None:
            given = level.withColumns(
                {"before": F.lit(None).cast("array<double>"), "last": F.lit(-1), "up": F.lit(0)}
            )
        else:
            own = level.withColumn("up", up)
            same = own["conv_id"].eqNullSafe(found["conv_id"]) & (own["up"] == found["place"])
            given = own.join(found, same).select(
                own["conv_id"], own["place"], "span", "up", "before", "last"
            )
        found = given.groupBy("conv_id", "up").applyInPandas(_passed_down, shape)
    return found.withColumnRenamed("place", "block")


_TURNS = "conv_id long, block long, piece long, role string, continues boolean, n_lines long, text string, rendered string"


def _turns(model: Chances):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            names = ("conv_id", "block", "parts", "is_first", "before", "last")
            columns = (batch.column(name).to_pylist() for name in names)
            scored = _block_scores(model, batch)
            for scores, conv, block, parts, first, before, last in zip(scored, *columns):
                lines = _block_lines(parts)
                start = model.start if first else (np.array(before)[:, None] + model.step).max(axis=0)
                states = path(model, scores, start, last)
                begins = np.flatnonzero(states < len(ROLES))
                cuts = begins.tolist() if len(begins) and begins[0] == 0 else [0, *begins.tolist()]
                for piece, (low, high) in enumerate(zip(cuts, [*cuts[1:], len(lines)])):
                    role = ROLES[states[low] % len(ROLES)]
                    own = lines[low:high]
                    if states[low] < len(ROLES):
                        own = [own[0][marker_of(own[0])[1] :], *own[1:]]
                    text = "\n".join(own).strip()
                    continues = bool(states[low] >= len(ROLES))
                    rows.append((conv, block, piece, role, continues, high - low, text, render(role, text)))
            names = [c.split()[0] for c in _TURNS.split(", ")]
            kinds = [pa.int64()] * 3 + [pa.string(), pa.bool_(), pa.int64(), pa.string(), pa.string()]
            columns = list(zip(*rows)) if rows else [[]] * len(names)
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return run


def parse(transcripts: DataFrame, model: Chances) -> DataFrame:
    """Turns of transcripts given as ``conv_id``, ``part`` and ``text``.

    A turn that runs over the end of a block goes on, marked ``continues``, in the next.
    """
    opened = _blocks(transcripts)
    many = opened.filter("n > 1").drop("n")
    spans = many.mapInArrow(_summaries(model), "conv_id long, place long, span array<double>")
    bounds = _entered(spans)
    return (
        opened.join(bounds, _same(opened, bounds), "left")
        .select(
            opened["conv_id"], opened["block"], "is_first", "marked", "blank", "parts", "before", "last"
        )
        .mapInArrow(_turns(model), _TURNS)
    )


def marked(conversations: DataFrame) -> DataFrame:
    """Conversations as raw transcripts: one part a turn, each conversation in one of four
    styles of speaker markers by its id; the last style has none."""
    role = F.coalesce("role", F.lit("user"))
    human = F.when(role == "user", "Human").when(role == "assistant", "AI").otherwise("System")
    text = F.coalesce("text", F.lit(""))
    style = F.pmod(F.xxhash64("conv_id"), F.lit(4))
    line: Column = (
        F.when(style == 0, F.concat(human, F.lit(": "), text))
        .when(style == 1, F.concat(F.lit("### "), role, F.lit("\n"), text))
        .when(style == 2, F.concat(F.lit("<|"), role, F.lit("|>"), text))
        .otherwise(text)
    )
    return conversations.select("conv_id", F.col("turn").alias("part"), line.alias("text"), "role")


def recovered(conversations: DataFrame) -> DataFrame:
    """The turns of a table of conversations, parsed from its transcripts without roles."""
    raw = marked(conversations)
    return parse(raw.drop("role"), learned(raw))
