"""Chat formatting in budgeted, turn-aligned windows.

A conversation's turns are rendered one by one; prefix sums of their token
counts choose spans of whole turns that fit the budget. Every window starts with
the conversation's system turn, repeats a limited history before its span and
ends with the span. Only assistant texts of the span are under the loss mask, so
that each is a target exactly once and repeated ones are masked.

Control strings inside texts and roles are escaped by one backslash after their
first character; backslashes already there are kept and one is added, so that
any text comes back whole and none can hold a control string.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from .common import partitions, slices

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
# The template's own marks and those of common chat formats.
CONTROL = (
    TURN,
    TEXT,
    END,
    "<s>",
    "</s>",
    "[INST]",
    "[/INST]",
    "<<SYS>>",
    "<</SYS>>",
    "<|im_start|>",
    "<|im_end|>",
    "<|startoftext|>",
    "<|endoftext|>",
)
_RAW = re.compile("|".join(rf"{re.escape(c[0])}\\*{re.escape(c[1:])}" for c in CONTROL))
_ESCAPED = re.compile("|".join(rf"{re.escape(c[0])}\\+{re.escape(c[1:])}" for c in CONTROL))
_PARSE = re.compile(f"{re.escape(TURN)}(.*?){re.escape(TEXT)}(.*?){re.escape(END)}", re.DOTALL)

WINDOW = (
    "conv_id bigint, window bigint, first_turn bigint, n_system bigint, n_history bigint, n_span bigint, "
    "n_tokens bigint, oversize boolean, text string, loss_spans array<bigint>"
)


def escape(text: str) -> str:
    return _RAW.sub(lambda m: m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: m[0][0] + m[0][2:], text)


def render(role: str, text: str) -> str:
    return f"{TURN}{escape(role)}{TEXT}{escape(text)}{END}\n"


def parse(formatted: str) -> list[tuple[str, str]]:
    return [(unescape(r), unescape(t)) for r, t in _PARSE.findall(formatted)]


@dataclass
class _Turn:
    role: str
    body: str
    tokens: int


class Windower:
    """Cuts one conversation, turn by turn; holds one window, the history and the system turn."""

    def __init__(self, budget: int, history: int, history_budget: int):
        self.budget, self.history, self.history_budget = budget, history, history_budget
        self.system: _Turn | None = None
        self.past: list[_Turn] = []
        self.span: list[_Turn] = []
        self.prefix = [0]
        self.n, self.window = 0, 0

    def room(self) -> int:
        fixed = (self.system.tokens if self.system and self.window else 0) + sum(t.tokens for t in self.past)
        return self.budget - fixed

    def add(self, turn: _Turn):
        if self.span and self.prefix[-1] + turn.tokens > self.room():
            yield self.close()
        if not self.span and self.n == 0 and turn.role == "system":
            self.system = turn
        while self.past and not self.span and turn.tokens > self.room():
            self.past.pop(0)
        self.span.append(turn)
        self.prefix.append(self.prefix[-1] + turn.tokens)
        self.n += 1

    def close(self) -> dict:
        repeated = ([self.system] if self.system and self.window else []) + self.past
        text, spans = "", []
        for k, t in enumerate(repeated + self.span):
            if k >= len(repeated) and t.role == "assistant":
                start = len(text) + t.body.index(TEXT) + len(TEXT)
                spans += [start, len(text) + len(t.body) - len(END) - 1]
            text += t.body
        total = sum(t.tokens for t in repeated + self.span)
        out = {
            "window": self.window,
            "first_turn": self.n - len(self.span),
            "n_system": int(bool(self.system and self.window)),
            "n_history": len(self.past),
            "n_span": len(self.span),
            "n_tokens": total,
            "oversize": total > self.budget,
            "text": text,
            "loss_spans": spans,
        }
        seen = [t for t in self.past + self.span if t is not self.system]
        self.past, used = [], 0
        for t in reversed(seen[-self.history :] if self.history else []):
            if used + t.tokens > self.history_budget:
                break
            self.past.insert(0, t)
            used += t.tokens
        self.span, self.prefix = [], [0]
        self.window += 1
        return out


def format_windows(
    turns: DataFrame,
    tokenizer: str,
    budget: int = 1024,
    history: int = 2,
    history_budget: int = 256,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """Windows of all conversations: text, loss spans (pairs of code point offsets) and counts.

    Turns go by turn number, then role and text; repeated rows are turns of
    their own. Null texts and roles are empty, a null conversation id is a
    conversation of its own. A turn that does not fit the budget, or what the
    repeated system turn leaves of it, is a window of its own, marked
    ``oversize``. Other columns are not looked at; no rows give none. Tokens are
    counted turn by turn, wherever a turn lies; then rows of a conversation pass
    in order through one task, which only adds counts up and holds one window.
    A turn's text is held whole.
    """

    def counted(batches):
        from tokenizers import Tokenizer

        tok = Tokenizer.from_file(tokenizer)
        tok.encode_special_tokens = True
        for part in slices(batches, 1024):
            bodies = [render(r, x) for r, x in zip(part.column("r").to_pylist(), part.column("x").to_pylist(), strict=True)]
            counts = [len(e.ids) for e in tok.encode_batch(bodies, add_special_tokens=False)]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(counts, pa.int64())], names=[*part.schema.names, "n"])

    def run(batches):
        names = [f.split()[0] for f in WINDOW.split(", ")]
        current, windower, ready = object(), None, []

        def batch_of(rows):
            kinds = {"oversize": pa.bool_(), "text": pa.string(), "loss_spans": pa.list_(pa.int64())}
            return pa.RecordBatch.from_arrays(
                [pa.array([r[n] for r in rows], kinds.get(n, pa.int64())) for n in names], names=names
            )

        for batch in slices(batches, 1024):
            convs, roles, texts, counts = (batch.column(k).to_pylist() for k in range(4))
            for conv, role, text, n in zip(convs, roles, texts, counts, strict=True):
                body = render(role, text)
                if windower is None or conv != current:
                    if windower is not None:
                        ready.append(windower.close() | {"conv_id": current})
                    current, windower = conv, Windower(budget, history, history_budget)
                ready += [w | {"conv_id": conv} for w in windower.add(_Turn(role, body, n))]
            if ready:
                yield batch_of(ready)
                ready = []
        if windower is not None:
            yield batch_of([windower.close() | {"conv_id": current}])

    rows = turns.select(
        F.col(conv_col).cast("bigint").alias("c"),
        F.coalesce(F.col(role_col), F.lit("")).alias("r"),
        F.coalesce(F.col(text_col), F.lit("")).alias("x"),
        F.col(turn_col).alias("t"),
    )
    rows = rows.mapInArrow(counted, T.StructType([*rows.schema.fields, T.StructField("n", T.LongType())]))
    ordered = rows.repartition(partitions(turns.sparkSession), "c").sortWithinPartitions("c", "t", "r", "x")
    return ordered.select("c", "r", "x", "n").mapInArrow(run, WINDOW)


def digest(windows: DataFrame) -> DataFrame:
    """What can be read back from the windows, one row per conversation."""
    schema = (
        "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
        "formatted_chars bigint, n_windows bigint"
    )

    def run(batches):
        state, current = None, None

        def row():
            return [current, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4], state[5]]

        def out(rows):
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
            names = [f.split()[0] for f in schema.split(", ")]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names
            )

        for batch in slices(batches):
            rows = []
            for r in batch.to_pylist():
                if state is None or r["conv_id"] != current:
                    if state is not None:
                        rows.append(row())
                    current, state = r["conv_id"], [0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
                for role, text in parse(r["text"])[r["n_system"] + r["n_history"] :]:
                    state[0] += 1
                    state[1].update(f"{role}\n{text}\n".encode("utf-8", "replace"))
                spans = r["loss_spans"]
                for a, b in zip(spans[::2], spans[1::2], strict=True):
                    target = unescape(r["text"][a:b])
                    state[2] += len(target)
                    state[3].update(target.encode("utf-8", "replace"))
                state[4] += len(r["text"])
                state[5] += 1
            if rows:
                yield out(rows)
        if state is not None:
            yield out([row()])

    n = partitions(windows.sparkSession)
    cols = ["conv_id", "window", "n_system", "n_history", "text", "loss_spans"]
    return windows.select(cols).repartition(n, "conv_id").sortWithinPartitions("conv_id", "window").mapInArrow(run, schema)
