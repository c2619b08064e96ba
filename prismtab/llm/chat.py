r"""Chat formatting from an event log: fold events into final messages, render them, read them back.

Events of one conversation, sorted by their sequence:

* ``message`` opens a message with a role and a first text, after all others,
* ``delta`` appends its text to a message,
* ``edit`` replaces a message's text,
* ``regenerate`` drops all that follows a message and begins its text anew.

Spark partitions the log by conversation and sorts it; a task folds its rows as
they stream by and holds one conversation at a time.

A rendered turn is its text between the marks of its role.  Inside texts every
control string is broken by a backslash behind its first character, and every
backslash is doubled, so no mark occurs in a text and the text can be
read back exactly.  The loss mask holds the places of the assistants' texts.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prismtab.llm.arrays import small_batches

#: role: marks before and behind its texts; any other role is written out before its text
MARKS = {"system": ("<<SYS>>", "<</SYS>>"), "user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>")}
OTHER = ("<<ROLE>>", "<<TEXT>>", "<</TEXT>>")
CONTROL = sorted({*(m for pair in MARKS.values() for m in pair), *OTHER, "<unk>"}, key=lambda m: (-len(m), m))
LEARNED = "assistant"
_ESCAPED = re.compile("|".join(map(re.escape, CONTROL)) + r"|\\")
_BACK = re.compile(r"\\(.)", re.S)


def escape(text: str) -> str:
    return _ESCAPED.sub(lambda m: m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    return _BACK.sub(r"\1", text)


def fold(events) -> list[tuple[str, str]]:
    """(role, text) of the messages that are left after the events (kind, message, role, text), in order.

    Events on a message that does not exist, and unknown kinds, change nothing.
    """
    order: list[list] = []  # [message, role, parts]
    for kind, message, role, text in events:
        if kind == "message":
            order.append([message, role, [text]])
            continue
        at = next((i for i in range(len(order) - 1, -1, -1) if order[i][0] == message), None)
        if at is None:
            continue
        if kind == "delta":
            order[at][2].append(text)
        elif kind == "edit":
            order[at][2] = [text]
        elif kind == "regenerate":
            del order[at + 1 :]
            order[at][2] = [text]
    return [(role, "".join(parts)) for _, role, parts in order]


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """(formatted text, places of the learned texts as code points from and to)."""
    out, at, spans = [], 0, []
    for role, text in turns:
        before, behind = MARKS.get(role) or (f"{OTHER[0]}{escape(role)}{OTHER[1]}", OTHER[2])
        text = escape(text)
        out += (before, text, behind)
        at += len(before)
        if role == LEARNED:
            spans.append((at, at + len(text)))
        at += len(text) + len(behind)
    return "".join(out), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of the turns of a formatted text."""
    turns, at = [], 0
    while at < len(formatted):
        for role, (before, behind) in MARKS.items():
            if formatted.startswith(before, at):
                at += len(before)
                break
        else:
            if not formatted.startswith(OTHER[0], at):
                raise ValueError(f"no turn begins at {at}")
            to = formatted.index(OTHER[1], at)
            role, behind, at = unescape(formatted[at + len(OTHER[0]) : to]), OTHER[2], to + len(OTHER[1])
        end = formatted.index(behind, at)
        turns.append((role, unescape(formatted[at:end])))
        at = end + len(behind)
    return turns


def events_of(turns: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The event log of a table of turns: each row opens a message and streams its text line by line.

    Rows of equal turns follow each other by role, then by the MD5 of their texts; a null text is empty, a null role the empty role, a null turn comes first.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = turns.select(
        F.col(conversation).alias("conversation"), F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"),
        whole.alias("text"), F.monotonically_increasing_id().alias("message"))
    # every line with its line feed
    lines = F.split("text", "(?<=\n)", -1)
    opened = F.array(F.struct(F.lit("message").alias("kind"), F.lit("").alias("text")))
    streamed = F.transform(lines, lambda line: F.struct(F.lit("delta").alias("kind"), line.alias("text")))
    seq = F.struct("turn", "role", F.md5(F.col("text").cast("binary")).alias("text"), "message")
    return rows.select("conversation", seq.alias("seq"), "message", "role", F.posexplode(F.concat(opened, streamed)).alias("part", "event")).select(
        "conversation", "seq", "part", F.col("event.kind").alias("kind"), "message", "role", F.col("event.text").alias("text"))


def conversations(events: DataFrame, order: list[str | Column]) -> DataFrame:
    """(conversation, n_turns, formatted, loss): one rendered conversation for each in the log.

    ``events`` has conversation, kind, message, role and text (nulls are empty texts
    and roles) and is folded in the order of the ``order`` columns; ``loss``
    is an array of (start, stop) code points.  A null conversation is one of its own.
    An empty log gives an empty result.
    """
    kind = events.schema["conversation"].dataType
    schema = T.StructType([
        T.StructField("conversation", kind), T.StructField("n_turns", T.LongType()), T.StructField("formatted", T.StringType()),
        T.StructField("loss", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("stop", T.LongType())])))])
    arrow = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
    ordered = small_batches(events).repartition("conversation").sortWithinPartitions("conversation", *order)
    ordered = ordered.select("conversation", "kind", "message", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))

    def run(frames):
        current, held, done = None, [], []

        def flushed(type_):
            columns = list(zip(*done))
            arrays = [pa.array(columns[0], type_), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.string()),
                      pa.array([[{"start": a, "stop": b} for a, b in x] for x in columns[3]], arrow)]
            done.clear()
            return pa.RecordBatch.from_arrays(arrays, schema.names)

        type_, size = None, 0
        for batch in frames:
            type_ = batch.column(0).type
            names = batch.column(0).to_pylist()
            for name, *event in zip(names, *(batch.column(i).to_pylist() for i in range(1, 5))):
                if held and name != current:
                    turns = fold(held)
                    done.append((current, len(turns), *render(turns)))
                    size += len(done[-1][2])
                    held = []
                    if size > 4 << 20:
                        yield flushed(type_)
                        size = 0
                current = name
                held.append(event)
        if held:
            turns = fold(held)
            done.append((current, len(turns), *render(turns)))
        if done:
            yield flushed(type_)

    return ordered.mapInArrow(run, schema)


def read_back(rendered: DataFrame) -> DataFrame:
    """(conversation, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars), all from the formatted text and its mask."""
    kind = rendered.schema["conversation"].dataType
    schema = T.StructType([
        T.StructField("conversation", kind), T.StructField("n_turns", T.LongType()), T.StructField("turns_sha256", T.StringType()),
        T.StructField("loss_chars", T.LongType()), T.StructField("loss_sha256", T.StringType()), T.StructField("formatted_chars", T.LongType())])

    def run(frames):
        for batch in frames:
            rows = []
            for formatted, loss in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                turns = parse(formatted)
                learned = "".join(unescape(formatted[x["start"] : x["stop"]]) for x in loss)
                digest = hashlib.sha256("".join(f"{role}\n{text}\n" for role, text in turns).encode()).hexdigest()
                rows.append((len(turns), digest, len(learned), hashlib.sha256(learned.encode()).hexdigest(), len(formatted)))
            columns = list(zip(*rows)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()))]], schema.names)

    return rendered.select("conversation", "formatted", "loss").mapInArrow(run, schema)
