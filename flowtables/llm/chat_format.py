"""Formatting of conversations with a compiled template (operator 8)."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowtables.llm.template import compiled, folded, parse, unescape

TEMPLATE = (
    "<s>{% for m in messages %}"
    "{% if m.role == 'user' %}[INST] {{ m.text | escape }} [/INST]"
    "{% elif m.role == 'assistant' %}[OUT]{% generation %}{{ m.text | escape }}{% endgeneration %}</s>"
    "{% else %}[TURN]{{ m.role | escape }}[NAME]{{ m.text | escape }}[/TURN]{% endif %}"
    "{% endfor %}"
)
# What the template above writes for one turn; escaped texts hold none of the marks.
TURN = re.compile(
    r"(?:<s>)?(?:\[INST\] (.*?) \[/INST\]|\[OUT\](.*?)</s>|\[TURN\](.*?)\[NAME\](.*?)\[/TURN\])", re.S
)
# Characters of one row of output; a longer conversation goes on in the next row.
PART = 1 << 20


def _turns(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("conv_id", "role", "text")]
        yield from zip(*columns)


def _formatter(template: str, part: int):
    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = compiled(template)

        def row(conv_id, number, pieces):
            text, spans, at = "".join(t for t, _ in pieces), [], 0
            for piece, generated in pieces:
                if generated and piece:
                    spans.append({"start": at, "stop": at + len(piece)})
                at += len(piece)
            return {"conv_id": conv_id, "part": number, "formatted": text, "spans": spans}

        rows, size = [], 0
        for conv_id, turns in groupby(_turns(batches), key=lambda t: t[0]):
            messages = ({"role": r or "", "text": t or ""} for _, r, t in turns)
            pieces, length, number = [], 0, 0
            for piece in run(messages):
                if length and length + len(piece[0]) > part:
                    rows.append(row(conv_id, number, pieces))
                    pieces, length, number = [], 0, number + 1
                pieces.append(piece)
                length += len(piece[0])
                size += len(piece[0])
                if size > part:
                    yield pa.RecordBatch.from_pylist(rows, SCHEMA)
                    rows, size = [], length
            rows.append(row(conv_id, number, pieces))
        yield pa.RecordBatch.from_pylist(rows, SCHEMA)

    return render


SCHEMA = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("part", pa.int64()),
        ("formatted", pa.string()),
        ("spans", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))),
    ]
)


def format_conversations(
    turns: DataFrame, template: str = TEMPLATE, part: int = PART
) -> DataFrame:
    """Formatted conversations: ``conv_id``, ``part``, ``formatted`` and ``spans`` (parts of ``formatted`` under the
    loss mask, as code point offsets).

    Turns of a conversation are rendered in order of ``turn``; equal numbers (null first) are ordered by role
    and text, so repeated rows are turns of their own. A null role or text is empty; rows with a null
    ``conv_id`` form one conversation. A conversation of more than about ``part`` characters continues in rows of
    ``part`` 1, 2, ..., one after the other in a partition: turns are sorted by Spark and rendered as a stream,
    so a task holds one row of output whatever the length of a conversation. Other columns are ignored.
    """
    folded(parse(template))  # a wrong template fails here, not in the tasks
    return (
        turns.select(
            F.col("conv_id").cast("bigint"),
            "turn",
            F.coalesce("role", F.lit("")).alias("role"),
            F.coalesce("text", F.lit("")).alias("text"),
        )
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
        .drop("turn")
        .mapInArrow(
            _formatter(template, part),
            "conv_id bigint, part bigint, formatted string, spans array<struct<start:bigint,stop:bigint>>",
        )
    )


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts = (row for batch in batches for row in batch.to_pylist())
    for conv_id, rows in groupby(parts, key=lambda r: r["conv_id"]):
        turns = loss = chars = 0
        turn_hash, loss_hash, rest = hashlib.sha256(), hashlib.sha256(), ""
        for row in rows:
            text = row["formatted"]
            chars += len(text)
            for span in row["spans"]:
                made = unescape(text[span["start"] : span["stop"]])
                loss += len(made)
                loss_hash.update(made.encode())
            rest, at = rest + text, 0
            for found in TURN.finditer(rest):
                user, assistant, role, other = found.groups()
                if found.start() != at:
                    raise ValueError(f"conversation {conv_id}: text between turns")
                if user is not None:
                    role, said = "user", user
                elif assistant is not None:
                    role, said = "assistant", assistant
                else:
                    role, said = unescape(role), other
                turn_hash.update(f"{role}\n{unescape(said)}\n".encode())
                turns, at = turns + 1, found.end()
            rest = rest[at:]
        if rest not in ("", "<s>"):
            raise ValueError(f"conversation {conv_id}: its end cannot be read")
        yield pa.RecordBatch.from_pylist(
            [
                {
                    "conv_id": conv_id,
                    "n_turns": turns,
                    "turns_sha256": turn_hash.hexdigest(),
                    "loss_chars": loss,
                    "loss_sha256": loss_hash.hexdigest(),
                    "formatted_chars": chars,
                }
            ],
            DIGEST,
        )


DIGEST = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("n_turns", pa.int64()),
        ("turns_sha256", pa.string()),
        ("loss_chars", pa.int64()),
        ("loss_sha256", pa.string()),
        ("formatted_chars", pa.int64()),
    ]
)


def digests(formatted: DataFrame) -> DataFrame:
    """What ``format_conversations`` wrote with ``TEMPLATE``, read back and summed up by conversation.

    Parts of a conversation must follow each other in their partition, as the formatter leaves them.
    """
    return formatted.mapInArrow(
        _read,
        "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
        "formatted_chars bigint",
    )
