"""Conversations as training examples: every reply with all turns before it, only the reply trainable."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wordsieve.llm.common import quoted

# The marks around a turn.
START, END = "<|im_start|>", "<|im_end|>"
REPLY = "assistant"

# Code points after which a section of a conversation ends; examples name the sections before theirs and don't repeat them.
SECTION_CHARS = 1 << 16

# A conversation of more turns than this, and more than one in HEAVY_SHARE of all, is dealt over several tasks.
HEAVY_TURNS = 4096
HEAVY_SHARE = 256

# Code points of output that a task holds before it hands them on.
BATCH_CHARS = 1 << 22

SPLIT = re.compile(re.escape(START) + "(.*?)\n(.*?)" + re.escape(END) + "\n", re.S)


def escaped(text: Column) -> Column:
    """A text in which no control string is left: ``<|`` gets a backslash, and one more where there are some already."""
    return F.regexp_replace(text, F.lit(r"<(\\*)\|"), F.lit(r"<\\$1|"))


def unescaped(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def escaped_role(role: Column) -> Column:
    """A role on one line."""
    return escaped(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def unescaped_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescaped(role))


def turns_of(text: str) -> list[tuple[str, str]]:
    """The (role, text) of a formatted text."""
    return [(unescaped_role(r), unescaped(t)) for r, t in SPLIT.findall(text)]


def formatted(conversations: DataFrame, section_chars: int = SECTION_CHARS) -> DataFrame:
    """Every assistant turn of the conversations (conv_id, turn, role, text) as an example: conv_id, section, reply, text,
    loss_begin, loss_end, whole, dealt.

    ``text`` holds the turns before the reply and the reply, each as ``<|im_start|>role``, its text and ``<|im_end|>``;
    control strings inside texts and roles are escaped, reversibly. loss_begin and loss_end bound the code points of the
    reply, the only trainable ones. Turns are in order of turn, role and text, nulls first.

    A conversation of up to ``section_chars`` is one section, so that its examples are complete. A longer one is cut,
    between turns, into sections, and an example starts at the section of its reply: before it belong the texts of
    the rows marked ``whole`` of the lower sections of its conversation, in their order. Otherwise the output would
    grow with the square of a conversation's length. The last row of a section is its whole one; where a section
    does not end with a reply that row has no loss bounds (null) and is no example.

    Whole conversations go to one task each, which holds no more than a section of text. Conversations of a large share of
    all turns, at most HEAVY_SHARE of them, are dealt over several tasks by turn, and a section ends where a task does; their
    rows are marked ``dealt``.

    Null texts and roles are empty; rows without a conversation are one conversation; repeated turns are kept. Other
    columns are left out. Empty tables give no rows.
    """
    return _formatted(conversations, section_chars)[0]


def _formatted(conversations: DataFrame, section_chars: int) -> tuple[DataFrame, bool]:
    """The examples, and whether any conversation is dealt over several tasks."""
    kind = conversations.schema["conv_id"].dataType
    counts = conversations.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    least = max(HEAVY_TURNS, conversations.count() // HEAVY_SHARE)
    heavy = [r.conv_id for r in counts.where(F.col("n") > least).collect()]
    named = [h for h in heavy if h is not None]
    dealt = F.col("conv_id").isNull() & F.lit(None in heavy) | F.coalesce(F.col("conv_id").isin(named), F.lit(False))
    none = F.lit("")
    turns = conversations.select(
        quoted("conv_id").alias("conv_id"),
        dealt.alias("dealt"),
        F.when(dealt, quoted("turn")).alias("_place"),
        quoted("turn").alias("_turn"),
        F.coalesce(quoted("role"), none).alias("role"),
        F.coalesce(quoted("text"), none).alias("text"),
    )
    ordered = turns.repartitionByRange("conv_id", "_place").sortWithinPartitions("conv_id", "_turn", "role", "text")
    rows = ordered.select("conv_id", escaped_role(F.col("role")).alias("role"), escaped(F.col("text")).alias("text"), (F.col("role") == REPLY).alias("is_reply"), "dealt")
    schema = T.StructType(
        [
            T.StructField("conv_id", kind),
            T.StructField("section", T.LongType()),
            T.StructField("reply", T.LongType()),
            T.StructField("text", T.StringType()),
            T.StructField("loss_begin", T.LongType()),
            T.StructField("loss_end", T.LongType()),
            T.StructField("whole", T.BooleanType()),
            T.StructField("dealt", T.BooleanType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Tasks are in the order of the turns, so numbers of sections that begin with the task's are too.
        section = TaskContext.get().partitionId() << 32
        out: list[list] = []
        chars = 0
        ids = None

        def flush() -> pa.RecordBatch:
            columns = [pa.array([row[i] for row in out], t) for i, t in enumerate((ids, pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_()))]
            return pa.RecordBatch.from_arrays(columns, names=schema.fieldNames())

        conv, begun, held, size, reply, open_row, spread = None, False, [], 0, 0, None, False

        def close() -> list | None:
            """Marks the last row of the section as its whole one, or gives a row of its own."""
            nonlocal held, size, section, open_row, reply
            rest = None
            if held:
                if open_row is not None:
                    open_row[6] = True
                else:
                    rest = [conv, section, reply, "".join(held), None, None, True, spread]
                section += 1
            held, size, open_row = [], 0, None
            return rest

        for batch in batches:
            ids = batch.schema.field(0).type
            for now, role, text, is_reply, dealt in zip(*(c.to_pylist() for c in batch.columns)):
                if not begun or now != conv:
                    if (rest := close()) is not None:
                        out.append(rest)
                        chars += len(rest[3])
                    conv, begun, reply, spread = now, True, 0, dealt
                head = f"{START}{role}\n"
                piece = f"{head}{text}{END}\n"
                open_row = None
                if is_reply:
                    context = "".join(held)
                    first = len(context) + len(head)
                    open_row = [conv, section, reply, context + piece, first, first + len(text), False, dealt]
                    held = [open_row[3]]
                    out.append(open_row)
                    chars += len(open_row[3])
                    reply += 1
                else:
                    held.append(piece)
                size += len(piece)
                if size >= section_chars:
                    if (rest := close()) is not None:
                        out.append(rest)
                        chars += len(rest[3])
                if chars >= BATCH_CHARS:
                    # The open row may still be marked, so it stays.
                    kept = out.pop() if open_row is not None else None
                    if out:
                        yield flush()
                    out, chars = ([], 0) if kept is None else ([kept], len(kept[3]))
        if (rest := close()) is not None:
            out.append(rest)
        if out:
            yield flush()

    return rows.mapInArrow(run, schema), bool(heavy)


def checked(conversations: DataFrame, section_chars: int = SECTION_CHARS) -> DataFrame:
    """``read_back`` of the examples of conversations, each where it was formatted; only dealt ones are brought together."""
    examples, any_dealt = _formatted(conversations, section_chars)
    if not any_dealt:
        return read_back(examples, True)
    return read_back(examples.where(~F.col("dealt")), True).unionByName(read_back(examples.where("dealt")))


def read_back(examples: DataFrame, in_order: bool = False) -> DataFrame:
    """What the examples of ``formatted`` hold, by conversation: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256,
    formatted_chars, n_examples.

    Turns are parsed from the rows that hold whole sections, trainable texts cut out by their bounds, both without their
    escapes. formatted_chars are the code points of all examples with the sections before them; turns that follow the last
    reply count as one more. A digest needs a conversation in order, so it meets one task, which reads it as a stream. Rows that
    come ``in_order``, as ``formatted`` gives those of conversations that aren't dealt, stay in their tasks.
    """
    kind = examples.schema["conv_id"].dataType
    parts = T.StructType(
        [
            T.StructField("conv_id", kind),
            T.StructField("section", T.LongType()),
            T.StructField("reply", T.LongType()),
            T.StructField("chars", T.LongType()),
            T.StructField("whole", T.BooleanType()),
            T.StructField("turns", T.LongType()),
            T.StructField("body", T.StringType()),
            T.StructField("loss", T.StringType()),
        ]
    )

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, _, _, texts, begins, ends, wholes = (c.to_pylist() for c in batch.columns)
            turns = [turns_of(t) if w else [] for t, w in zip(texts, wholes)]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:3],
                    pa.array([len(t) for t in texts], pa.int64()),
                    batch.column(6),
                    pa.array([len(t) for t in turns], pa.int64()),
                    pa.array(["".join(f"{r}\n{t}\n" for r, t in own) for own in turns], pa.string()),
                    pa.array([None if b is None else unescaped(t[b:e]) for t, b, e in zip(texts, begins, ends)], pa.string()),
                ],
                names=parts.fieldNames(),
            )

    result = T.StructType(
        [
            T.StructField("conv_id", kind),
            T.StructField("n_turns", T.LongType()),
            T.StructField("turns_sha256", T.StringType()),
            T.StructField("loss_chars", T.LongType()),
            T.StructField("loss_sha256", T.StringType()),
            T.StructField("formatted_chars", T.LongType()),
            T.StructField("n_examples", T.LongType()),
        ]
    )

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = None

        def rows(done: list, ids: pa.DataType) -> pa.RecordBatch:
            columns = [[d[0] for d in done], [d[1] for d in done], [d[2].hexdigest() for d in done], [d[3] for d in done],
                       [d[4].hexdigest() for d in done], [d[5] + d[8] for d in done], [d[6] for d in done]]
            kinds = (ids, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=result.fieldNames())

        for batch in batches:
            ids = batch.schema.field(0).type
            done = []
            for conv, _, _, chars, whole, turns, body, loss in zip(*(c.to_pylist() for c in batch.columns)):
                if own is None or own[0] != conv:
                    if own is not None:
                        done.append(own)
                    # id, turns, their digest, trainable code points, their digest, code points, examples, those of closed sections, of an open rest
                    own = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0, 0, 0]
                own[8] = 0
                if loss is None:
                    own[8] = own[7] + chars
                else:
                    own[3] += len(loss)
                    own[4].update(loss.encode())
                    own[5] += own[7] + chars
                    own[6] += 1
                if whole:
                    own[1] += turns
                    own[2].update(body.encode())
                    own[7] += chars
            if done:
                yield rows(done, ids)
        if own is not None:
            yield rows([own], ids)

    parsed = examples.select("conv_id", "section", "reply", "text", "loss_begin", "loss_end", "whole").mapInArrow(parse, parts)
    ordered = parsed if in_order else parsed.repartition("conv_id").sortWithinPartitions("conv_id", "section", "reply")
    return ordered.mapInArrow(digest, result)
