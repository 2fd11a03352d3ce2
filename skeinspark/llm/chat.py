"""Chat formatting, with turn spans found by incremental black-box rendering.

``render(turns)`` is a black box from a list of (role, text) to a string.  Rendering successive prefixes
of a conversation and comparing consecutive outputs gives the span of each turn: what the longer output has
beyond the shorter one.  A template whose longer output does not begin with the shorter one rewrites
history and has no spans.  The built-in template marks turns with control strings and escapes them inside
roles and texts, reversibly, so that everything can be read back from the output.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import lean, pick, ready

# Control strings of the built-in template and of templates that texts may imitate.
OPEN, CLOSE, END = "[INST]", "[/INST]", "</s>"
CONTROL = (OPEN, CLOSE, END, "<s>", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>", "<|endoftext|>")
ESCAPE = "\\"
SPEAKER = "assistant"

Turn = tuple[str, str]
Render = Callable[[list[Turn]], str]


def escape(text: str) -> str:
    """text without any control string: every character that opens one, the line end and the escape sign itself become two characters."""
    return re.sub(r"[\\\[<\n]", lambda m: ESCAPE + ("n" if m[0] == "\n" else "(" if m[0] == "[" else "{" if m[0] == "<" else m[0]), text)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: {"n": "\n", "(": "[", "{": "<"}.get(m[1], m[1]), text, flags=re.S)


def instruct(turns: list[Turn]) -> str:
    """Each turn is a role line, then its text: between [INST] and [/INST], or for the assistant up to </s>."""
    return "".join(f"{escape(role)}\n{escape(text)}{END}" if role == SPEAKER else f"{OPEN}{escape(role)}\n{escape(text)}{CLOSE}" for role, text in turns)


def read_instruct(span: str) -> tuple[str, int, int]:
    """Role of a turn's span, and where its escaped text starts and ends."""
    start, tail = (len(OPEN), len(CLOSE)) if span.startswith(OPEN) else (0, len(END))
    line = span.index("\n")
    return unescape(span[start:line]), line + 1, len(span) - tail


class Rewrites(ValueError):
    """The template changed what it had rendered for a shorter conversation."""


def spans(render: Render, turns: list[Turn]) -> tuple[str, list[tuple[int, int]]]:
    """The whole rendering, and each turn's (start, end) in it."""
    before, found = render([]), []
    for i in range(1, len(turns) + 1):
        after = render(turns[:i])
        if not after.startswith(before):
            raise Rewrites(f"turn {i - 1} changes earlier output")
        found.append((len(before), len(after)))
        before = after
    return before, found


def rewrites_history(render: Render, samples: Iterable[list[Turn]]) -> bool:
    for turns in samples:
        try:
            spans(render, turns)
        except Rewrites:
            return True
    return False


def trimmed(turns: list[Turn]) -> str:
    """A template that drops earlier assistant texts: one that rewrites history, for tests."""
    last = max((i for i, t in enumerate(turns) if t[0] == SPEAKER), default=-1)
    return "".join(f"{OPEN}{escape(r)}\n{escape('' if r == SPEAKER and i < last else t)}{CLOSE}" for i, (r, t) in enumerate(turns))


def format_chats(conversations: DataFrame, render: Render = instruct, read: Callable[[str], tuple[str, int, int]] = read_instruct, plain: Callable[[str], str] = unescape) -> DataFrame:
    """conv_id, text, error, and turns (role, text, start, end, text_start, text_end, loss) of every conversation.

    render makes the output of turns, read finds role and text in a turn's span, plain undoes the escapes of a text.
    Rows with equal conv_id are a conversation, in order of turn, then role, then text; nulls first.  A null role or text
    is empty; a null conv_id is a conversation.  start and end delimit the turn in the output, text_start and
    text_end its escaped text; loss is true for assistant texts.  If the template rewrites history, error says so and
    turns is null.  Other columns are ignored.  A conversation is one text and so is rendered whole in one task.
    """
    ready(conversations.sparkSession)
    rows = pick(conversations, conv_id="bigint", turn="bigint", role="string", text="string")
    rows = rows.select("conv_id", F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).alias("t"))
    grouped = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    turn = pa.struct([("role", pa.string()), ("text", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("text_start", pa.int64()), ("text_end", pa.int64()), ("loss", pa.bool_())])

    def run(batches):
        for batch in batches:
            texts, errors, found = [], [], []
            for turns in batch.column(1):
                turns = [(t["role"], t["text"]) for t in turns.as_py()]
                try:
                    text, at = spans(render, turns)
                except Rewrites as e:
                    texts.append(render(turns))
                    errors.append(str(e))
                    found.append(None)
                    continue
                texts.append(text)
                errors.append(None)
                out = []
                for start, end in at:
                    role, a, b = read(text[start:end])
                    out.append({"role": role, "text": plain(text[start + a : start + b]), "start": start, "end": end, "text_start": start + a, "text_end": start + b, "loss": role == SPEAKER})
                found.append(out)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string()), pa.array(errors, pa.string()), pa.array(found, pa.list_(turn))], names=["conv_id", "text", "error", "turns"])

    schema = "conv_id bigint, text string, error string, turns array<struct<role: string, text: string, start: bigint, end: bigint, text_start: bigint, text_end: bigint, loss: boolean>>"
    return grouped.mapInArrow(lean(run), schema)


def digests(formatted: DataFrame) -> DataFrame:
    """The digest columns of the contract, from what was read back from the output."""
    turns = F.concat_ws("", F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))))
    loss = F.concat_ws("", F.transform(F.filter("turns", lambda t: t["loss"]), lambda t: t["text"]))
    return formatted.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(turns, 256).alias("turns_sha256"),
        F.length(loss).cast("bigint").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.length("text").cast("bigint").alias("formatted_chars"),
    )
