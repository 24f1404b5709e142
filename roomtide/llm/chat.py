"""Chat formatting in budgeted windows with a loss mask.

A conversation's turns are streamed in order. The prefix sums of their token counts choose windows
of whole turns: a window opens with the system turn (if the conversation starts with one), repeats
up to `history` of the last turns of the window before while they fit half the budget, and then takes new
turns until the next one would pass `budget`. A turn larger than the budget is a window's only new turn; no
turn is cut. The budget counts text, not the template's marks. Repeated turns are masked, so each assistant text is under the loss mask once.

A turn is written as <|im_start|>ROLE\\nTEXT<|im_end|>\\n. Inside roles and texts every "<|" becomes
"<\\|" and every "<\\" becomes "<\\\\", which no text can undo by itself; `unescape` reverses it.
The loss mask is a list of [start, end) spans of code points in the formatted text.

Turns are ordered by turn (null first), then role, then text; equal rows stay repeated. Null role
or text is empty, a null conv_id is a conversation of its own. Other columns are ignored; an empty
table gives no rows. A conversation is read as a sorted stream and only one window is held.
"""

from __future__ import annotations

import hashlib
import re
from collections import deque
from collections.abc import Callable, Iterable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch_of, rows, slices

START, END = "<|im_start|>", "<|im_end|>\n"
BUDGET, HISTORY = 1024, 2
WINDOW = "conv_id long, window long, n_repeated int, text string, loss array<struct<start: long, stop: long>>"
_TOKEN = re.compile(r"\w+|[^\w\s]")
_SPAN = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))


def count_tokens(text: str) -> int:
    """Words and single marks; a tokenizer's `lambda t: len(encode(t))` may take its place."""
    return sum(1 for _ in _TOKEN.finditer(text))


def escape(text: str) -> str:
    return text.replace("<\\", "<\\\\").replace("<|", "<\\|")


def unescape(text: str) -> str:
    return re.sub(r"<\\([|\\])", r"<\1", text)


def escape_role(role: str) -> str:
    """A role stands on one line: its line breaks become a sign that escaped text can't hold."""
    return escape(role).replace("\n", "<\\n")


def unescape_role(role: str) -> str:
    return re.sub(r"<\\([|\\n])", lambda m: "\n" if m[1] == "n" else f"<{m[1]}", role)


def format_turns(turns: list[tuple[str, str]], n_repeated: int) -> tuple[str, list[dict[str, int]]]:
    """Text and loss spans of a window whose first `n_repeated` turns were seen before."""
    parts, at, spans = [], 0, []
    for i, (role, text) in enumerate(turns):
        head, body = f"{START}{escape_role(role)}\n", escape(text)
        if i >= n_repeated and role == "assistant":
            spans.append({"start": at + len(head), "stop": at + len(head) + len(body)})
        parts += [head, body, END]
        at += len(head) + len(body) + len(END)
    return "".join(parts), spans


def parse_turns(text: str) -> list[tuple[str, str]]:
    out = []
    for part in text.split(START)[1:]:
        role, body = part.removesuffix(END).split("\n", 1)
        out.append((unescape_role(role), unescape(body)))
    return out


def windows(
    turns: Iterable[tuple[str, str]], budget: int = BUDGET, history: int = HISTORY, count: Callable[[str], int] = count_tokens
) -> Iterator[tuple[list[tuple[str, str]], int]]:
    """(turns, number of leading turns that an earlier window had) of each window."""
    system: list = []
    new: list = []
    opening: list = []
    recent: deque = deque(maxlen=history)
    used = 0
    for i, (role, text) in enumerate(turns):
        size = count(text)
        if new and used + size > budget:
            yield [t for t, _ in opening + new], len(opening)
            back: list = []
            used = sum(n for _, n in system)
            for pair in reversed(recent):
                if used + pair[1] > budget // 2:
                    break
                back.insert(0, pair)
                used += pair[1]
            opening, new = system + back, []
        new.append(((role, text), size))
        used += size
        if i == 0 and role == "system":
            system = list(new)
        else:
            recent.append(((role, text), size))
    if new:
        yield [t for t, _ in opening + new], len(opening)


def _format(budget: int, history: int, count: Callable[[str], int]):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        held = 0

        def flush() -> pa.RecordBatch:
            return batch_of({
                "conv_id": (pa.int64(), [o[0] for o in out]), "window": (pa.int64(), [o[1] for o in out]),
                "n_repeated": (pa.int32(), [o[2] for o in out]), "text": (pa.string(), [o[3] for o in out]), "loss": (_SPAN, [o[4] for o in out]),
            })

        for conv, group in groupby(rows(slices(batches), "conv_id", "role", "text"), lambda r: r[0]):
            for n, (turns, repeated) in enumerate(windows(((r, t) for _, r, t in group), budget, history, count)):
                text, spans = format_turns(turns, repeated)
                out.append((conv, n, repeated, text, spans))
                held += len(text)
                if held > 8_000_000:
                    yield flush()
                    out, held = [], 0
        yield flush()

    return run


def format_chats(
    turns: DataFrame, budget: int = BUDGET, history: int = HISTORY, count: Callable[[str], int] = count_tokens
) -> DataFrame:
    """Formatted windows: conv_id, window, n_repeated, text, loss spans."""
    empty = F.lit("")
    ready = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), empty).alias("role"), F.coalesce(F.col("text").cast("string"), empty).alias("text"),
    )
    ready = ready.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ready.mapInArrow(_format(budget, history, count), WINDOW)


def _digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
    out: list[tuple] = []

    def flush() -> pa.RecordBatch:
        return batch_of({n: (k, [o[i] for o in out]) for i, (n, k) in enumerate(zip(names, kinds, strict=True))})

    for conv, group in groupby(rows(batches, "conv_id", "n_repeated", "text", "loss"), lambda r: r[0]):
        every, loss, n, chars, size = hashlib.sha256(), hashlib.sha256(), 0, 0, 0
        for _, repeated, text, spans in group:
            for role, body in parse_turns(text)[repeated:]:
                every.update(f"{role}\n{body}\n".encode())
                n += 1
            for span in spans:
                body = unescape(text[span["start"]:span["stop"]])
                loss.update(body.encode())
                chars += len(body)
            size += len(text)
        out.append((conv, n, every.hexdigest(), chars, loss.hexdigest(), size))
        if len(out) >= 10_000:
            yield flush()
            out = []
    yield flush()


def read_chats(formatted: DataFrame) -> DataFrame:
    """Per conversation what the formatted windows hold: turns, text under the mask, length."""
    ordered = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "window")
    return ordered.mapInArrow(
        _digest, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    )
