"""Chat formatting: roles of transcript lines by a hidden Markov model, then canonical turns.

A line's hidden state is a role and whether the line begins a turn. What is seen of a line is
its speaker marker, if any, and a few features: question mark, length, first letter, blank.
Transition and emission chances are counted on labelled transcripts with smoothing; Viterbi
finds the likeliest states of a whole conversation.

A conversation is decoded in chunks of ``CHUNK`` lines, so that none, however long, meets in
one task. If it has several, each chunk first gives the best score between every two states at
its ends (a max-plus matrix); a scan over these few matrices fixes the states at the chunk
borders, and the chunks are decoded between them. That is exactly Viterbi on the whole.

Canonical turns drop the markers and stand between ``<|role|>`` and ``<|end|>`` lines.

Every turn is in a transcript. One whose role is null or none of the three stands there without a
marker, and its lines teach the model nothing; they are given the likeliest role like any other.

Nulls: a null line counts as a blank one; lines of a null conversation are one conversation; turns
without a number come last. Turns with one number follow each other whole, by role, a hash
of the text and place of reading; repeated rows are turns of their own. A very long turn is cut into chunks like
any other lines. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wirestar.llm.common import id_remainder
from wirestar.operators.numbering import number_rows
from wirestar.sources.staging import Staging

ROLES = ("system", "user", "assistant")
#: States: role r beginning a turn is 2 * r, going on 2 * r + 1.
STATES = 2 * len(ROLES)
CHUNK = 2_000
FOLDS, HELD_OUT = 5, 0
SMOOTHING = 0.5
_IMPOSSIBLE = -1e30

# Names that speakers go by in transcripts.
NAMES = {
    "system": "system sys instruction instructions context prompt",
    "user": "user human customer client question q me you prompter",
    "assistant": "assistant ai bot agent gpt answer a model response support",
}
_ROLE_OF = {name: i for i, role in enumerate(ROLES) for name in NAMES[role].split()}
_MARKER = re.compile(
    r"^\s*(?:#{1,4}\s*|\*\*|\[|<\|?|>\s*)?([A-Za-z]{1,14})\s*"
    r"(?:\*\*\s*[:>]|[:>]|\]\s*:?|\|?>|\s*$)\s*(?:\*\*)?\s*"
)
#: Markers: none, one of each role, a name not known.
_NO_MARK, _OTHER_NAME = 0, 1 + len(ROLES)
_FEATURES = (2 + len(ROLES), 2, 4, 3)  # values of each feature

# How the made transcripts mark system, user and assistant.
_STYLES = (
    ("System: ", "User: ", "Assistant: "),
    ("### Instruction\n", "### Human: ", "### Assistant: "),
    ("[system] ", "[Customer] ", "[Agent] "),
    ("**Context:** ", "**Q:** ", "**A:** "),
    ("<|system|>", "<|user|>", "<|assistant|>"),
)


def marker(line: str) -> tuple[int, int]:
    """The marker at a line's start and where the text after it begins. A bare word is a
    marker only if it is a known name."""
    found = _MARKER.match(line)
    if not found:
        return _NO_MARK, 0
    role = _ROLE_OF.get(found[1].lower())
    if role is not None:
        if found.end() < len(line) or found[0].strip() != found[1]:
            return 1 + role, found.end()
        return 1 + role, len(line)
    signed = found[0].strip() != found[1] and found[1][0].isupper()
    return (_OTHER_NAME, found.end()) if signed else (_NO_MARK, 0)


def features(line: str) -> tuple[int, int, int, int]:
    mark, begin = marker(line)
    text = line[begin:].strip()
    length = 0 if not text else 1 if len(text) < 40 else 2 if len(text) < 160 else 3
    first = 0 if not text else 1 if text[0].isupper() else 2
    return mark, int(text.endswith("?")), length, first


@dataclass(frozen=True)
class Model:
    """Logarithms: ``begin`` (states), ``move`` (states, states), and per feature
    (values, states)."""

    begin: np.ndarray
    move: np.ndarray
    emit: tuple[np.ndarray, ...]

    def seen(self, lines: list[str]) -> np.ndarray:
        """Log chance of each line in each state."""
        rows = np.array([features(x) for x in lines], dtype=np.int64).reshape(-1, len(_FEATURES))
        return sum(e[rows[:, i]] for i, e in enumerate(self.emit))


def model_from(counts: dict[tuple[str, int, int], int]) -> Model:
    """From counts of (kind, value, state); ``kind`` is begin, move (value: state before) or a
    feature's number. A marker of a role favours that role even where little was counted."""
    def table(kind: str, values: int) -> np.ndarray:
        return np.array([[counts.get((kind, v, s), 0) for s in range(STATES)] for v in range(values)], float)

    possible = np.array([[b == 2 * (b // 2) or a // 2 == b // 2 for b in range(STATES)] for a in range(STATES)])
    move = table("move", STATES) + SMOOTHING * possible
    move = np.where(possible, np.log(np.maximum(move, 1e-9) / move.sum(axis=1, keepdims=True)), _IMPOSSIBLE)
    first = table("begin", 1)[0] + SMOOTHING * (np.arange(STATES) % 2 == 0)
    begin = np.where(np.arange(STATES) % 2 == 0, np.log(np.maximum(first, 1e-9) / first.sum()), _IMPOSSIBLE)
    emit = []
    for i, values in enumerate(_FEATURES):
        seen = table(str(i), values) + SMOOTHING
        if i == 0:
            for role in range(len(ROLES)):
                seen[1 + role, 2 * role] += 20
        emit.append(np.log(seen / seen.sum(axis=0, keepdims=True)))
    return Model(begin, move, tuple(emit))


# --- Viterbi --------------------------------------------------------------------------------


def viterbi(seen: np.ndarray, model: Model, start: np.ndarray, end: int | None = None) -> np.ndarray:
    """The best states of a chunk. ``start`` is the score of each state at its first line before
    that line is seen; ``end`` fixes the last state."""
    best, back = start + seen[0], np.zeros(seen.shape, dtype=np.int64)
    for t in range(1, len(seen)):
        ways = best[:, None] + model.move
        back[t] = ways.argmax(axis=0)
        best = ways[back[t], np.arange(STATES)] + seen[t]
    path = np.empty(len(seen), dtype=np.int64)
    path[-1] = int(best.argmax()) if end is None else end
    for t in range(len(seen) - 1, 0, -1):
        path[t - 1] = back[t, path[t]]
    return path


def between_ends(seen: np.ndarray, model: Model) -> np.ndarray:
    """(states, states): the best score of a chunk that begins in one state and ends in the
    other."""
    total = np.where(np.eye(STATES, dtype=bool), seen[0][None, :], _IMPOSSIBLE)
    for row in seen[1:]:
        total = (total[:, :, None] + model.move[None]).max(axis=1) + row
    return total


def border_states(matrices: list[np.ndarray], model: Model) -> list[tuple[int, int]]:
    """First and last state of every chunk of a conversation, given its matrices in order."""
    best, back = None, []
    for m in matrices:
        if best is None:
            entry, came = model.begin, np.zeros(STATES, dtype=np.int64)
        else:
            ways = best[:, None] + model.move
            came, entry = ways.argmax(axis=0), ways.max(axis=0)
        total = entry[:, None] + m
        first, best = total.argmax(axis=0), total.max(axis=0)
        back.append((first, came))
    last, states = int(best.argmax()), []
    for first, came in reversed(back):
        begin = int(first[last])
        states.append((begin, last))
        last = int(came[begin])
    return states[::-1]


# --- Spark ----------------------------------------------------------------------------------


def _in_chunks(lines: DataFrame, work: Callable[[list[dict]], list[tuple]], schema: str) -> DataFrame:
    """Run ``work`` over the rows of every chunk. Chunks stream by in order, so a task holds
    one at a time."""
    names = [f.split(" ")[0] for f in schema.split(", ")]
    rows = lines.repartition("conv_id", "chunk").sortWithinPartitions("conv_id", "chunk", "line_no", "line")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for batch in batches:
            out: list[tuple] = []
            for row in batch.to_pylist():
                if held and (row["conv_id"], row["chunk"]) != (held[0]["conv_id"], held[0]["chunk"]):
                    out += work(held)
                    held = []
                held.append(row)
            if out:
                yield _table(out, names, schema)
        if held:
            yield _table(work(held), names, schema)

    return rows.mapInArrow(run, schema)


_ARROW = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(),
          "array<double>": pa.list_(pa.float64())}


def _table(rows: list[tuple], names: list[str], schema: str) -> pa.RecordBatch:
    kinds = [f.split(" ")[1] for f in schema.split(", ")]
    columns = list(zip(*rows)) or [()] * len(names)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=_ARROW[k]) for c, k in zip(columns, kinds)], names=names
    )


def transcript_lines(
    conversations: DataFrame, staging: Staging, chunk: int = CHUNK
) -> DataFrame:
    """Lines of rough transcripts, as if pasted from many places, made from ``conversations``
    (conv_id, turn, role, text), with the true ``state`` of each line, null where the role is
    none of ``ROLES``.

    How speakers are marked differs by conversation, and one turn in six has no marker. Lines
    are numbered over their conversation without gathering it, and a chunk is ``chunk`` of them.
    """
    role = F.array_position(F.array(*map(F.lit, ROLES)), F.col("role")).cast("int") - 1
    role = F.when(role >= 0, role)
    style = F.pmod(F.xxhash64("conv_id"), F.lit(len(_STYLES)))
    names = F.array(*(F.array(*(F.lit(n) for n in style)) for style in _STYLES))
    bare = F.pmod(F.xxhash64("conv_id", "turn"), F.lit(6)) == 0
    mark = F.when(bare, "").otherwise(F.coalesce(F.get(F.get(names, style), role), F.lit("")))
    turns = conversations.select(
        F.col("conv_id").cast("string").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        role.alias("r"),
        F.xxhash64("role", "text").alias("said"),
        F.monotonically_increasing_id().alias("row"),
        F.concat(mark, F.coalesce("text", F.lit(""))).alias("text"),
    )
    lines = turns.select(
        "conv_id", "turn", "r", "said", "row", F.posexplode(F.split("text", "\n")).alias("i", "line")
    )
    order = [F.col("turn").asc_nulls_last(), F.col("r").asc_nulls_last(), "said", "row", "i"]
    order = [F.col(c) if isinstance(c, str) else c for c in order]
    numbered = number_rows(lines, order, "line_no", staging, group_by=["conv_id"], start=-1).df
    return numbered.select(
        "conv_id",
        F.floor(F.col("line_no") / chunk).alias("chunk"),
        "line_no",
        "line",
        (2 * F.col("r") + (F.col("i") > 0).cast("int")).alias("state"),
    )


def learn(lines: DataFrame) -> Model:
    """From ``lines`` with their true ``state``: only counts reach the driver."""
    schema = "kind string, value int, state int, n long"

    def count(held: list[dict]) -> list[tuple]:
        counts: dict[tuple, int] = {}
        before = None
        for row in held:
            state = row["state"]
            if state is None:
                before = None
                continue
            keys = [(str(i), v, state) for i, v in enumerate(features(row["line"] or ""))]
            if before is not None:
                keys.append(("move", before, state))
            elif row["line_no"] == 0:
                keys.append(("begin", 0, state))
            for key in keys:
                counts[key] = counts.get(key, 0) + 1
            before = state
        return [(*k, n) for k, n in counts.items()]

    counted = _in_chunks(lines, count, schema).groupBy("kind", "value", "state")
    rows = counted.agg(F.sum("n").alias("n")).collect()  # at most a few hundred
    return model_from({(r.kind, r.value, r.state): r.n for r in rows})


def decode(lines: DataFrame, model: Model, staging: Staging) -> DataFrame:
    """Turns of all conversations: conv_id, chunk, turn (number in its chunk), role, continues
    (a turn that goes on from the chunk before), n_lines, chat (canonical text)."""
    lines = lines.select("conv_id", "chunk", "line_no", F.coalesce("line", F.lit("")).alias("line"))
    several = lines.where("chunk > 0").select(F.col("conv_id").alias("_long")).distinct()
    several = staging.write(several, "long-conversations")
    long_lines = lines.join(several.df, F.col("conv_id").eqNullSafe(F.col("_long")), "left_semi")
    plain = lines.withColumns({"first": F.lit(None).cast("int"), "last": F.lit(None).cast("int")})
    if several.rows:
        borders = staging.write(_borders(long_lines, model), "borders").df
        borders = borders.withColumnsRenamed({"conv_id": "_conv", "chunk": "_chunk"})
        here = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("chunk") == F.col("_chunk"))
        plain = lines.join(borders, here, "left").drop("_conv", "_chunk")

    def turns(held: list[dict]) -> list[tuple]:
        texts = [row["line"] for row in held]
        start, end = model.begin, held[0]["last"]
        if held[0]["first"] is not None:
            start = np.where(np.arange(STATES) == held[0]["first"], 0.0, _IMPOSSIBLE)
        states = viterbi(model.seen(texts), model, start, end).tolist()
        found: list[tuple[int, bool, list[str]]] = []
        for state, text in zip(states, texts):
            if state % 2 == 0 or not found:
                found.append((state // 2, state % 2 == 1, []))
            begin = marker(text)[1] if state % 2 == 0 else 0
            found[-1][2].append(text[begin:].rstrip())
        head = held[0]["conv_id"], held[0]["chunk"]
        return [
            (*head, n, ROLES[role], on, len(said), canonical(ROLES[role], said))
            for n, (role, on, said) in enumerate(found)
        ]

    schema = "conv_id string, chunk long, turn long, role string, continues boolean, n_lines long, chat string"
    return _in_chunks(plain, turns, schema)


def canonical(role: str, said: list[str]) -> str:
    return f"<|{role}|>\n" + "\n".join(said).strip("\n") + "\n<|end|>\n"


def _borders(lines: DataFrame, model: Model) -> DataFrame:
    """First and last state of every chunk of long conversations."""
    def matrix(held: list[dict]) -> list[tuple]:
        found = between_ends(model.seen([row["line"] for row in held]), model)
        return [(held[0]["conv_id"], held[0]["chunk"], found.ravel().tolist())]

    matrices = _in_chunks(lines, matrix, "conv_id string, chunk long, scores array<double>")

    def scan(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("chunk", ignore_index=True)
        states = border_states([np.array(s).reshape(STATES, STATES) for s in part["scores"]], model)
        first, last = zip(*states)
        return part[["conv_id", "chunk"]].assign(first=first, last=last)

    # One row per chunk of a conversation.
    return matrices.groupBy("conv_id").applyInPandas(scan, "conv_id string, chunk long, first int, last int")


def format_conversations(conversations: DataFrame, staging: Staging) -> DataFrame:
    """Canonical turns of all ``conversations``' transcripts, with the model learned on those
    that are not held out."""
    lines = staging.write(transcript_lines(conversations, staging), "lines").df
    known = lines.where(F.coalesce(id_remainder(F.col("conv_id"), FOLDS) != HELD_OUT, F.lit(False)))
    return decode(lines, learn(known), staging)
