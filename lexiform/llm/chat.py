"""Format conversations of typed content parts, with attachments and a loss mask, and read them back.

A turn's content is a list of parts: text, image, audio or document. A visitor flattens the parts in
order: text is escaped, any other part becomes a placeholder, and its reference, position and number
of expanded tokens are recorded. Control strings inside texts are broken up by an escape that reading
undoes exactly, so nothing a user writes can open or close a turn.

A turn is ``<|turn:ROLE|>CONTENT</s>``, a conversation ``<s>`` and its turns. The loss mask covers
the content of assistant turns and nothing else.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from lexiform.llm.batches import record_batch

CONTROL = ["<s>", "</s>", "<|", "|>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"]
ROW_CHARS = 1_000_000  # formatted characters after which a conversation goes on in another row
PART_TYPE = (
    "array<struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>>"
)

# The first character of a control string, wherever one starts.
_starts = re.compile("|".join(f"{re.escape(c[0])}(?={re.escape(c[1:])})" for c in CONTROL))
_escapes = re.compile(r"\\(.)", re.DOTALL)
_turn = re.compile(r"<\|turn:(.*?)\|>(.*?)</s>", re.DOTALL)


def escape(text: str) -> str:
    r"""Double backslashes, and put ``\.`` behind the first character of every control string."""
    return _starts.sub(lambda m: m.group() + "\\.", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _escapes.sub(lambda m: "\\" if m.group(1) == "\\" else "", text)


class PartVisitor:
    """Flattens one turn's parts; placeholders are numbered over the conversation."""

    def __init__(self, patch: int = 28, frames: float = 25.0, page_tokens: int = 256):
        self.patch, self.frames, self.page_tokens = patch, frames, page_tokens

    def visit(self, part: dict) -> tuple[str, tuple | None]:
        """Formatted text of a part and, unless it is text, (kind, ref, tokens)."""
        kind = part.get("kind") or "text"
        visitor = getattr(self, f"visit_{kind}", None)
        if visitor is None:
            raise ValueError(f"unknown kind of content part: {kind}")
        return visitor(part)

    def visit_text(self, part: dict):
        return escape(part.get("text") or ""), None

    def visit_image(self, part: dict):
        across = math.ceil((part.get("width") or 0) / self.patch)
        down = math.ceil((part.get("height") or 0) / self.patch)
        return "<|image|>", ("image", part.get("ref"), max(1, across * down))

    def visit_audio(self, part: dict):
        tokens = math.ceil((part.get("seconds") or 0.0) * self.frames)
        return "<|audio|>", ("audio", part.get("ref"), max(1, tokens))

    def visit_document(self, part: dict):
        tokens = (part.get("pages") or 0) * self.page_tokens
        return "<|document|>", ("document", part.get("ref"), max(1, tokens))


def merged(parts: list[dict]) -> Iterator[dict]:
    """Neighbouring texts as one, so that no control string can arise where they meet."""
    text = None
    for part in parts:
        if part is None:
            continue
        if (part.get("kind") or "text") == "text":
            text = (text or "") + (part.get("text") or "")
            continue
        if text is not None:
            yield {"kind": "text", "text": text}
            text = None
        yield part
    if text is not None:
        yield {"kind": "text", "text": text}


def as_parts(messages: DataFrame, text: str = "text") -> DataFrame:
    """Messages whose content is one text, in the typed form."""
    null = F.lit(None)
    part = F.struct(
        F.lit("text").alias("kind"), F.coalesce(F.col(text), F.lit("")).alias("text"),
        null.cast("string").alias("ref"), null.cast("int").alias("width"),
        null.cast("int").alias("height"), null.cast("double").alias("seconds"),
        null.cast("int").alias("pages"),
    )
    return messages.select("conv_id", "turn", "role", F.array(part).alias("parts"))


FORMATTED = StructType(
    [
        StructField("conv_id", LongType()),
        StructField("shard", LongType()),
        StructField("n_turns", LongType()),
        StructField("text", StringType()),
        StructField(
            "loss",
            ArrayType(StructType([StructField(n, LongType()) for n in ("start", "length")])),
        ),
        StructField(
            "attachments",
            ArrayType(
                StructType(
                    [
                        StructField("at", LongType()),
                        StructField("kind", StringType()),
                        StructField("ref", StringType()),
                        StructField("tokens", LongType()),
                    ]
                )
            ),
        ),
    ]
)


def format_conversations(messages: DataFrame) -> DataFrame:
    """Rows of (conv_id, turn, role, parts) as formatted conversations.

    One row per conversation, or several numbered shards, split between turns, once a row holds
    ROW_CHARS characters: tasks stream sorted turns and hold one row at a time, so a conversation of
    any length passes. ``loss`` and ``attachments`` give character places in the row's text. Turns
    are ordered by turn; equal turns by role and parts; null turns come first. A null conv_id is a
    conversation of its own; null roles, parts and texts are empty. An empty table gives no rows.
    The rows of a conversation stay together and in order.
    """
    ordered = (
        messages.select(
            F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"),
            F.coalesce("role", F.lit("")).alias("role"),
            F.coalesce(F.col("parts"), F.array().cast(PART_TYPE)).cast(PART_TYPE).alias("parts"),
        )
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "parts")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        visitor = PartVisitor()
        current, shard, turns, pieces, at, loss, held = None, 0, 0, [], 0, [], []
        rows: list[tuple] = []
        for batch in batches:
            columns = (batch.column(n).to_pylist() for n in ("conv_id", "role", "parts"))
            for conv, role, parts in zip(*columns):
                if current is None or current[0] != conv or at >= ROW_CHARS:
                    if current is not None:
                        rows.append((current[0], shard, turns, "".join(pieces), loss, held))
                    same = current is not None and current[0] == conv
                    shard = shard + 1 if same else 0
                    current, turns, loss, held = (conv,), 0, [], []
                    pieces = [] if same else ["<s>"]
                    at = sum(map(len, pieces))
                head = f"<|turn:{escape(role)}|>"
                start = at = at + len(head)
                pieces.append(head)
                for part in merged(parts):
                    made, attachment = visitor.visit(part)
                    if attachment:
                        held.append((at, *attachment))
                    pieces.append(made)
                    at += len(made)
                if role == "assistant":
                    loss.append((start, at - start))
                pieces.append("</s>")
                at += len("</s>")
                turns += 1
            if rows:
                yield record_batch(FORMATTED, dict(zip(FORMATTED.names, zip(*rows))))
                rows = []
        if current is not None:
            rows.append((current[0], shard, turns, "".join(pieces), loss, held))
            yield record_batch(FORMATTED, dict(zip(FORMATTED.names, zip(*rows))))

    return ordered.mapInArrow(run, FORMATTED)


def parse_turns(text: str) -> Iterator[tuple[str, str]]:
    """Role and content of each turn of a formatted row, unescaped."""
    for role, content in _turn.findall(text):
        yield unescape(role), unescape(content)


def conversation_digests(formatted: DataFrame) -> DataFrame:
    """Per conversation, read back from its formatted rows, which follow one another in order.

    conv_id, n_turns, turns_sha256 (role, newline, text, newline of each turn), loss_chars and
    loss_sha256 (the text under the loss mask) and formatted_chars.
    """
    schema = StructType(
        [
            StructField("conv_id", LongType()),
            StructField("n_turns", LongType()),
            StructField("turns_sha256", StringType()),
            StructField("loss_chars", LongType()),
            StructField("loss_sha256", StringType()),
            StructField("formatted_chars", LongType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, rows = None, []
        n = chars = loss_chars = 0
        turns = losses = None

        def done():
            return (current, n, turns.hexdigest(), loss_chars, losses.hexdigest(), chars)

        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("conv_id", "shard", "text", "loss"))
            for conv, shard, text, loss in zip(*columns):
                if shard == 0:
                    if turns is not None:
                        rows.append(done())
                    current, n, chars, loss_chars = conv, 0, 0, 0
                    turns, losses = hashlib.sha256(), hashlib.sha256()
                chars += len(text)
                for role, content in parse_turns(text):
                    turns.update(f"{role}\n{content}\n".encode("utf-8", "surrogatepass"))
                    n += 1
                for span in loss:
                    masked = unescape(text[span["start"] : span["start"] + span["length"]])
                    losses.update(masked.encode("utf-8", "surrogatepass"))
                    loss_chars += len(masked)
            if rows:
                yield record_batch(schema, dict(zip(schema.names, zip(*rows))))
                rows = []
        if turns is not None:
            yield record_batch(schema, dict(zip(schema.names, zip(done()))))

    return formatted.mapInArrow(run, schema)
