"""Chat formatting from event logs.

A conversation is a log of events: whole messages, streamed deltas, edits and regenerations, in any arrival order.
The log is partitioned by conversation and message, sorted by sequence and folded: a message's text is that of its last
whole version (``message``, ``edit`` or ``regenerate``) followed by the deltas after it. Messages keep the place of their
first event. A conversation is never gathered: its messages are rows, each rendered on its own, and a hot conversation
spreads over tasks by message.

The rendered form of a message is ``### role: text </turn>`` and a newline. Backslash, ``#`` and ``<`` inside a role or a text carry a
backslash, so control strings can't occur there and reading back is exact.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import re
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

EVENTS = ("message", "edit", "regenerate", "delta", "delete")
OPEN, BETWEEN, CLOSE = "### ", ": ", " </turn>\n"
_TURN = re.compile(r"### ([^\\#<:]*(?:\\.[^\\#<:]*)*): ([^\\#<]*(?:\\.[^\\#<]*)*) </turn>\n", re.DOTALL)
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)


def _escaped(text: Column, signs: str) -> Column:
    return F.regexp_replace(text, f"([{signs}])", r"\\$1")


def fold(events: DataFrame) -> DataFrame:
    """``(conv_id, place, role, text)``: the final messages of ``events(conv_id, message, seq, event, role, text)``.

    ``message`` names a message within its conversation; ``place`` is the sequence of its first event. Deltas after the
    last whole version are joined in order of ``seq``, ties by text; without a whole version all deltas count. A
    ``delete`` after all of that removes the message. The role is the last one given that is not null. Null texts are
    empty, null events whole messages, null sequences come first; unknown events raise.
    """
    known = F.coalesce(F.col("event"), F.lit("message"))
    rows = events.select(
        "conv_id", "message", "seq",
        F.when(known.isin(*EVENTS), known).otherwise(F.raise_error(F.concat(F.lit("unknown event: "), known))).alias("event"),
        "role", F.coalesce("text", F.lit("")).alias("text"),
    )
    # Whole versions and deltas at one sequence: the version comes first.
    order = F.struct(F.col("seq"), F.when(F.col("event") == "delta", 1).when(F.col("event") == "delete", 2).otherwise(0), F.col("text"))
    part = rows.withColumn("at", order)
    whole = ~F.col("event").isin("delta", "delete")
    last = part.groupBy("conv_id", "message").agg(
        F.min("seq").alias("first_seq"), F.count("seq").alias("with_seq"), F.count("*").alias("n"),
        F.max(F.when(whole, F.col("at"))).alias("base"), F.max("at").alias("end"),
        F.max(F.when(F.col("event") == "delete", F.col("at"))).alias("gone"),
        F.max(F.when(F.col("role").isNotNull(), F.struct("at", "role"))).alias("named"),
    ).withColumn("place", F.when(F.col("with_seq") == F.col("n"), F.col("first_seq")))
    # A delta belongs to the message whose last version it follows; a version is its own.
    keys = [F.col(f"p.{k}").eqNullSafe(F.col(f"l.{k}")) for k in ("conv_id", "message")]
    live = part.alias("p").join(last.where("gone IS NULL OR gone < end").alias("l"), keys[0] & keys[1]).where(
        "p.event <> 'delete' AND (l.base IS NULL OR p.at >= l.base) AND (l.gone IS NULL OR p.at > l.gone)"
    )
    return (
        live.groupBy("p.conv_id", "p.message")
        .agg(
            F.first("l.place").alias("place"), F.first("l.named.role").alias("role"),
            F.array_join(F.transform(F.array_sort(F.collect_list("p.at")), lambda x: x["text"]), "").alias("text"),
        )
        .select("conv_id", "message", "place", "role", "text")
    )


def render(messages: DataFrame) -> DataFrame:
    """``messages`` with ``formatted`` and ``loss``, an array of ``(start, end)`` code points of it under the loss mask.

    The mask covers the text of assistant messages, as written with its escapes. Null roles are empty, null texts too.
    """
    role = _escaped(F.coalesce("role", F.lit("")), r"\\#<:")
    text = _escaped(F.coalesce("text", F.lit("")), r"\\\\#<")
    rows = messages.withColumn("head", F.concat(F.lit(OPEN), role, F.lit(BETWEEN))).withColumn("body", text)
    start = F.char_length("head")
    mask = F.when(F.col("role") == "assistant", F.array(F.struct(start.alias("start"), (start + F.char_length("body")).alias("end"))))
    return rows.select(
        *messages.columns, F.concat("head", "body", F.lit(CLOSE)).alias("formatted"),
        F.coalesce(mask, F.array().cast("array<struct<start:int,end:int>>")).alias("loss"),
    )


def read_back(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts of rendered messages that follow each other."""
    out, at = [], 0
    while at < len(formatted):
        turn = _TURN.match(formatted, at)
        if turn is None:
            raise ValueError(f"no message at {at}")
        out.append(tuple(_ESCAPED.sub(r"\1", part) for part in turn.groups()))
        at = turn.end()
    return out


class _Digest:
    def __init__(self, conv_id) -> None:
        self.conv_id = conv_id
        self.turns = self.loss_chars = self.chars = 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, formatted: str, loss: list[dict]) -> None:
        self.chars += len(formatted)
        for role, text in read_back(formatted):
            self.turns += 1
            self.all.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
        for span in loss:
            text = _ESCAPED.sub(r"\1", formatted[span["start"] : span["end"]])
            self.loss_chars += len(text)
            self.loss.update(text.encode("utf-8", "surrogatepass"))

    def row(self) -> tuple:
        return self.conv_id, self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def digests(rendered: DataFrame) -> DataFrame:
    """Counts and digests of each conversation of ``rendered(conv_id, place, formatted, loss)``, read back from ``formatted``.

    Messages stream through in order, so a task holds one batch of them; a digest of a whole conversation is
    sequential by nature, and a hot conversation is one task's stream. Null ids are one conversation.
    """
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    id_type = rendered.schema["conv_id"].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(done: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done, strict=True)], names=names)

        current, done = None, []
        for batch in batches:
            for conv, formatted, loss in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                if current is None or conv != current.conv_id:
                    if current is not None:
                        done.append(current.row())
                    current = _Digest(conv)
                current.add(formatted, loss)
            if len(done) > 5000:
                yield made(done)
                done = []
        if current is not None:
            yield made([*done, current.row()])

    ordered = rendered.repartition("conv_id").sortWithinPartitions("conv_id", "place", "formatted")
    return ordered.select("conv_id", "formatted", "loss").mapInArrow(
        rows, f"conv_id {id_type}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
    )


def events_of(turns: DataFrame) -> DataFrame:
    """Rows of ``turns(conv_id, turn, role, text)`` as whole messages; equal rows stay as many."""
    copy = F.row_number().over(Window.partitionBy("conv_id", "turn", "hash").orderBy(F.lit(1)))
    hashed = turns.select("conv_id", "turn", "role", "text", F.xxhash64("role", "text").alias("hash"))
    return hashed.select(
        "conv_id", F.struct("turn", "hash", copy.alias("copy")).alias("message"), F.col("turn").alias("seq"),
        F.lit("message").alias("event"), "role", "text",
    )
