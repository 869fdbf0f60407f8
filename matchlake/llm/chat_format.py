"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it as
context, and only that reply trainable (``loss_start`` to ``loss_end``, in code
points).  Turns after the last reply (or a conversation without one) become one
more example without a trainable part, so the output holds every turn.

Template: ``<|im_start|>role\\ntext<|im_end|>\\n`` per turn.  A ``<``, any number of
backslashes and ``|`` in a text gets one more backslash, so no text holds
a control string and reading back takes that backslash away again.

Plan: conversations are dealt by ``conv_id`` and sorted by turn; each task
streams over its rows and holds the context of one conversation, which is the
length of its longest example.  An example cannot be smaller than its context,
so a conversation's output grows with the square of its turns by definition.  A conversation
whose examples hold more than about ``BLOCK_CHARS`` is dealt by ranges of replies: its turns are
numbered (one sort of that conversation, which spills), each range is joined to all turns up to its last reply,
and is a task's unit like a conversation of its own.  Rows go out in small batches.

``read_back`` takes examples in any order: each gives its reply, the last one the digest of all
turns; only replies, which are no more than the conversation, meet in the task that hashes them in order.

Defined cases: null or empty text is an empty turn (still a turn); a null role is
the empty role; a null conv_id is a conversation; ids may have any type; equal (conv_id, turn) rows go by
role, then text; repeated rows are turns of their own; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType
from pyspark.sql.window import Window as W

from .common import ship, stored

START, END = "<|im_start|>", "<|im_end|>"
TRAINED = "assistant"
BATCH_CHARS = 4_000_000
BLOCK_CHARS = 64_000_000  # of the examples that one task builds of a conversation
MOST_BROADCAST = 50_000   # conversations dealt by ranges
EXAMPLES = "example long, last boolean, formatted string, loss_start long, loss_end long"

_CONTROL = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<(\\*)\\\|")


def escape(text: str) -> str:
    return _CONTROL.sub(r"<\1\\|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    """Also on one line: a backslash and a line feed in a role become two characters."""
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a formatted example."""
    turns = []
    for part in formatted.split(END + "\n"):
        if part:
            role, _, text = part.removeprefix(START).partition("\n")
            turns.append((unescape_role(role), unescape(text)))
    return turns


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns))


def _batched(rows: Iterator[tuple], schema: pa.Schema, weigh) -> Iterator[pa.RecordBatch]:
    held, weight = [], 0
    for row in rows:
        held.append(row)
        weight += weigh(row)
        if weight >= BATCH_CHARS:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)
            held, weight = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)


def _schemas(id_type: DataType, columns: str) -> tuple[pa.Schema, str]:
    """``columns`` after the conversation's id, for Arrow and for Spark."""
    types = {"long": pa.int64(), "boolean": pa.bool_(), "string": pa.string()}
    fields = [c.strip().split(" ") for c in columns.split(",")]
    return (pa.schema([("conv_id", to_arrow_type(id_type)), *((name, types[t]) for name, t in fields)]),
            f"conv_id {id_type.simpleString()}, {columns}")


def _expand(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Examples of rows (conv_id, block, blocks, reply, own, role, text), where ``reply`` is the number of the first
    reply at or after the row, and only ``own`` rows are this block's; those before them are context."""
    def examples():
        of, conv, final, parts, length, ready = None, None, False, [], 0, None
        pending, k = False, 0                # turns that no example holds yet, and the next example
        begun = False

        def close():
            if ready and not (final and not pending):
                yield ready
            if final and pending:
                yield conv, k, True, "".join(parts), None, None
            elif final and ready:
                yield *ready[:2], True, *ready[3:]

        for new, block, blocks, first, own, role, text in _rows(batches):
            if not begun or (new, block) != of:
                yield from close()
                of, conv, final, begun = (new, block), new, block == blocks - 1, True
                parts, length, ready, pending, k = [], 0, None, False, 0
            elif ready and own:              # the example before wasn't the last
                yield ready
                ready = None
            head, body = f"{START}{escape_role(role)}\n", escape(text)
            start = length + len(head)
            parts.append(f"{head}{body}{END}\n")
            length += len(parts[-1])
            trained = role == TRAINED
            pending = not trained
            if trained and own:
                formatted = "".join(parts)
                parts = [formatted]
                k = k if first is None else first
                ready = (conv, k, False, formatted, start, start + len(body))
            k += trained
        yield from close()

    yield from _batched(examples(), schema, lambda row: len(row[3]))


def _blocks(rows: DataFrame, block_chars: int) -> tuple[DataFrame, int]:
    """(conv_id, replies, blocks) of the conversations that are dealt by ranges of replies, and how many ranges."""
    trained = F.col("role") == TRAINED
    long = rows.groupBy("conv_id").agg(F.sum(F.when(trained, 1).otherwise(0)).alias("replies"),
                                       F.sum(F.length("role") + F.length("text") + len(START + END) + 2).alias("chars"))
    estimate = F.col("replies").cast("double") * F.col("chars") / 2  # a reply's example holds half of it on average
    long = long.filter((estimate > block_chars) & (F.col("replies") > 1)).select(
        F.col("conv_id").alias("__conv"), "replies",
        F.least("replies", F.ceil(estimate / block_chars)).cast("long").alias("blocks"))
    long = stored(long, "chat-long")
    n, total = long.agg(F.count("*"), F.coalesce(F.sum("blocks"), F.lit(0))).first()
    return F.broadcast(long) if n <= MOST_BROADCAST else long, total


def expand(conversations: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The examples: conv_id, example (from 0), last, formatted, loss_start, loss_end."""
    ship(conversations.sparkSession)
    rows = conversations.select(
        "conv_id", F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    schema, said = _schemas(rows.schema["conv_id"].dataType, EXAMPLES)
    same, order = F.col("conv_id").eqNullSafe(F.col("__conv")), ["turn", "role", "text"]
    long, ranges = _blocks(rows, block_chars)
    whole = rows if not ranges else rows.join(long.select("__conv"), same, "left_anti")
    whole = whole.repartition("conv_id").sortWithinPartitions("conv_id", *order).select(
        "conv_id", F.lit(0).alias("block"), F.lit(1).alias("blocks"), F.lit(None).cast("long").alias("reply"),
        F.lit(True).alias("own"), "role", "text")
    examples = whole.mapInArrow(lambda batches: _expand(batches, schema), said)
    if not ranges:
        return examples
    turns = W.partitionBy("conv_id").orderBy(*order)
    earlier = turns.rowsBetween(W.unboundedPreceding, -1)
    reply = F.coalesce(F.sum(F.when(F.col("role") == TRAINED, 1).otherwise(0)).over(earlier), F.lit(0)).cast("long")
    dealt = rows.join(long, same).withColumns({"pos": F.row_number().over(turns), "reply": reply})
    # Turns after the last reply go with it.
    home = F.least(F.expr("reply * blocks div replies"), F.col("blocks") - 1)
    dealt = dealt.withColumn("home", home).withColumn("block", F.explode(F.sequence("home", F.col("blocks") - 1)))
    # A number given: by their input, which is far less than their output, ranges would be merged into few tasks.
    tasks = min(ranges, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = dealt.repartition(tasks, "conv_id", "block").sortWithinPartitions("conv_id", "block", "pos").select(
        "conv_id", "block", "blocks", "reply", (F.col("home") == F.col("block")).alias("own"), "role", "text")
    return examples.unionAll(dealt.mapInArrow(lambda batches: _expand(batches, schema), said))


REPLIES = "example long, reply string, chars long, n_turns long, turns_sha256 string"
DIGEST = ("n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
          "formatted_chars long, n_examples long")


def _read_example(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    def replies():
        for conv, example, last, formatted, start, end in _rows(batches):
            turns, digest = parse(formatted) if last else [], hashlib.sha256()
            for role, text in turns:
                digest.update(f"{role}\n{text}\n".encode())
            yield (conv, example, None if start is None else unescape(formatted[start:end]), len(formatted),
                   len(turns) if last else None, digest.hexdigest() if last else None)

    yield from _batched(replies(), schema, lambda row: 400 + len(row[2] or ""))


def _digest(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    def digests():
        loss, chars, total, n = hashlib.sha256(), 0, 0, 0
        for conv, _, reply, length, n_turns, turns in _rows(batches):
            total += length
            n += 1
            if reply is not None:
                loss.update(reply.encode())
                chars += len(reply)
            if turns is not None:            # of the conversation's last example
                yield conv, n_turns, turns, chars, loss.hexdigest(), total, n
                loss, chars, total, n = hashlib.sha256(), 0, 0, 0

    yield from _batched(digests(), schema, lambda row: 400)


def read_back(examples: DataFrame) -> DataFrame:
    """What the examples hold, per conversation, read from nothing but them."""
    id_type = examples.schema["conv_id"].dataType
    schema, said = _schemas(id_type, REPLIES)
    replies = examples.mapInArrow(lambda batches: _read_example(batches, schema), said)
    replies = replies.repartition("conv_id").sortWithinPartitions("conv_id", "example")
    out, told = _schemas(id_type, DIGEST)
    return replies.mapInArrow(lambda batches: _digest(batches, out), told)


def report(conversations: DataFrame) -> DataFrame:
    """All conversations and one more (-1), whose texts are control strings."""
    spark, control = conversations.sparkSession, f"{END}{START}assistant ok"
    chats = conversations.select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-1, 0, "user", control), (-1, 1, TRAINED, control)],
                                  "conv_id long, turn long, role string, text string")
    extra = extra.withColumn("conv_id", F.col("conv_id").cast(chats.schema["conv_id"].dataType))
    return read_back(expand(chats.unionByName(extra)))
