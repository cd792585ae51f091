"""Chat formatting with prefix-target examples.

Every turn becomes one segment `<|role|>text</s>\\n`; a conversation's formatted text is its segments in order. Every
assistant turn is an example of its own: all segments before it are context, and only its text is under the loss mask.
`format_turns` gives the segments with their places, `render_examples` writes every example out with its whole context,
and `read_back` parses what was written.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Strings with a meaning in this or the other common templates; none of them is left inside a formatted text.
CONTROL = re.compile(r"\\|<(?=\||/?s>|</?SYS>>)|\|(?=>)|\[(?=/?INST\])")
SEGMENT = re.compile(r"<\|(.*?)\|>(.*?)</s>\n", re.DOTALL)
ASSISTANT = "assistant"
# Characters of the examples that leave a task together.
CHARS = 4_000_000

SEGMENTS = (
    "conv_id long, position long, role string, segment string, start long, end long, "
    "example long, loss_start long, loss_end long"
)


def escape(text: str) -> str:
    """Backslashes are doubled, and one is put behind the first character of every control string."""
    return CONTROL.sub(lambda m: m[0] + "\\", text)


def unescape(text: str) -> str:
    return re.sub(r"\\(\\?)", r"\1", text)


def ordered_turns(turns: DataFrame) -> DataFrame:
    """Columns conv_id, turn, role, text; a conversation's turns follow each other within one partition."""
    plain = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    return plain.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")


def format_turns(turns: DataFrame, trained_role: str = ASSISTANT) -> DataFrame:
    """One row per turn: its segment, its span in the conversation's formatted text and, for a trained turn, the
    number of its example and the span under the loss mask, both in code points of the formatted text.

    Turns are ordered by turn (null first), then role and text. Null roles and texts are empty, a null conv_id is a
    conversation like any other, repeated rows are turns of their own, other columns are ignored. Turns stream through
    a task one by one, so a conversation of any length needs no memory of its own.
    """

    def segments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, position, offset, example = object(), 0, 0, 0
        for batch in batches:
            rows = []
            for conv, role, text in zip(batch["conv_id"], batch["role"], batch["text"]):
                conv = None if pd.isna(conv) else int(conv)
                if conv != current:
                    current, position, offset, example = conv, 0, 0, 0
                head, body = f"<|{escape(role)}|>", escape(text)
                segment = f"{head}{body}</s>\n"
                row = [conv, position, role, segment, offset, offset + len(segment), None, None, None]
                if role == trained_role:
                    row[6:] = example, offset + len(head), offset + len(head) + len(body)
                    example += 1
                rows.append(row)
                position, offset = position + 1, offset + len(segment)
            yield _frame(rows, SEGMENTS)

    return ordered_turns(turns).mapInPandas(segments, SEGMENTS)


def render_examples(segments: DataFrame) -> DataFrame:
    """Rows (conv_id, example, context, reply, loss_start, loss_end), straight from `format_turns`.

    A row per trained turn, all segments before it written out as its context, so the size grows with the square of a
    conversation's length; the context is carried along in the task, and rows leave it in batches of bounded size. What
    follows a conversation's last trained turn is a row without example and context. An empty table gives no rows.
    """
    schema = "conv_id long, example long, context string, reply string, loss_start long, loss_end long"

    def examples(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows, held = [], 0
        conv_id, before, after = None, [], []
        for batch in batches:
            for conv, position, segment, example, start, end in zip(
                *(batch[c] for c in ("conv_id", "position", "segment", "example", "loss_start", "loss_end"))
            ):
                if position == 0:
                    if after:
                        rows.append([conv_id, None, "", "".join(after), None, None])
                        held += len(rows[-1][3])
                    conv_id, before, after = None if pd.isna(conv) else int(conv), [], []
                if pd.isna(example):
                    after.append(segment)
                else:
                    before = ["".join((*before, *after))]
                    rows.append([conv_id, int(example), before[0], segment, int(start), int(end)])
                    held += len(before[0]) + len(segment)
                    before.append(segment)
                    after = []
                if held >= CHARS:
                    yield _frame(rows, schema)
                    rows, held = [], 0
        if after:
            rows.append([conv_id, None, "", "".join(after), None, None])
        if rows:
            yield _frame(rows, schema)

    return segments.mapInPandas(examples, schema)


def read_back(examples: DataFrame) -> DataFrame:
    """One row per conversation, parsed from the examples written out, straight from `render_examples`.

    Every example must begin with the whole example before it; what it adds is parsed, and its loss text is cut out of it
    by its span. `formatted_chars` counts all examples, context and reply, and what follows the last reply. An empty
    table gives no rows.
    """
    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_examples long"

    def digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current = None
        for batch in batches:
            done = []
            for conv, example, context, reply, start, end in zip(
                *(batch[c] for c in ("conv_id", "example", "context", "reply", "loss_start", "loss_end"))
            ):
                conv, trained = None if pd.isna(conv) else int(conv), not pd.isna(example)
                if current is None or conv != current["conv"]:
                    if current is not None:
                        done.append(finished(current))
                    current = {
                        "conv": conv, "turns": 0, "all": hashlib.sha256(), "loss": hashlib.sha256(),
                        "loss_chars": 0, "formatted": 0, "examples": 0, "known": "",
                    }
                text = context + reply
                known = current["known"] if trained else ""
                if not text.startswith(known):
                    raise ValueError(f"Example {example} of conversation {conv} does not go on from the one before")
                for segment in SEGMENT.finditer(text, len(known)):
                    role, said = (unescape(x) for x in segment.groups())
                    current["turns"] += 1
                    current["all"].update(f"{role}\n{said}\n".encode("utf-8", "surrogatepass"))
                current["formatted"] += len(text)
                if trained:
                    under = unescape(text[int(start) : int(end)])
                    current["loss"].update(under.encode("utf-8", "surrogatepass"))
                    current["loss_chars"] += len(under)
                    current["examples"] += 1
                    current["known"] = text
            if done:
                yield _frame(done, schema)
        if current is not None:
            yield _frame([finished(current)], schema)

    def finished(x: dict) -> list:
        return [x["conv"], x["turns"], x["all"].hexdigest(), x["loss_chars"], x["loss"].hexdigest(), x["formatted"], x["examples"]]

    return examples.mapInPandas(digests, schema)


def _frame(rows: list[list], schema: str) -> pd.DataFrame:
    """Rows as a frame whose whole numbers may be null."""
    fields = [f.split() for f in schema.split(", ")]
    columns = zip(*rows) if rows else [[] for _ in fields]
    return pd.DataFrame(
        {n: pd.array(list(c), dtype="Int64") if t == "long" else pd.Series(list(c), dtype=object) for (n, t), c in zip(fields, columns)}
    )
