"""Chat formatting into budgeted windows.

Each conversation is laid out in windows of at most ``budget`` tokens that
start and end at turns: the running sums of turn tokens decide where a window
ends.  A turn's tokens are those of what is written, marks and escapes included.  Every later window of a conversation repeats its system turn and up to
``history`` turns before its first new turn (as many as still leave room for
that turn); repeated turns carry no loss, so each assistant turn is a target
exactly once.  The template marks turns as

    <|im_start|>role<|im_sep|>text<|im_end|>\\n

and every control string inside a role or text gets the escape character
after its first character (an escape character itself is doubled), which
:func:`unescape` undoes exactly.

Defined cases: a null text or role is empty; turns are ordered by (turn, role,
text), nulls first, so repeated rows stay, next to each other; a turn larger
than the budget has a window to itself and is never cut, which is the only
window above the budget; a window whose first new turn leaves no room for the
system turn goes without it; a conversation without system turn repeats none; an empty table gives an
empty result.  Conversations are dealt in blocks of turn numbers, each
formatted as one stream in constant memory, so a conversation of any length
is spread over tasks; the last ``history`` turn numbers of a block are handed
to the next one.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
# Control strings of this and of other common templates.
CONTROL = (START, SEP, END, "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
ESCAPE = "␛"
BLOCK = 256

_BEGINS = re.compile("(?=" + "|".join(map(re.escape, CONTROL)) + ")(.)", re.S)
_ESCAPED = re.compile(ESCAPE + f"({ESCAPE}?)")
_TURN = re.compile(re.escape(START) + "(.*?)" + re.escape(SEP) + "(.*?)" + re.escape(END) + "\n", re.S)


def escape(s: str) -> str:
    return _BEGINS.sub(r"\1" + ESCAPE, s.replace(ESCAPE, ESCAPE * 2))


def unescape(s: str) -> str:
    return _ESCAPED.sub(r"\1", s)


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) pairs of a formatted window."""
    return [(unescape(r), unescape(t)) for r, t in _TURN.findall(formatted)]


_COUNTERS: dict = {}


def token_counter(path: str, pattern: str):
    """Tokens of a text under a tiktoken rank file."""
    if path not in _COUNTERS:
        import tiktoken
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _COUNTERS[path] = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks,
                                            special_tokens={})
    enc = _COUNTERS[path]
    return lambda s: len(enc.encode_ordinary(s))


WINDOW_SCHEMA = ("conv_id long, block long, window int, formatted string, n_repeated int, "
                 "loss array<struct<start:int,stop:int>>, n_tokens int")
_ARROW = pa.schema([
    ("conv_id", pa.int64()), ("block", pa.int64()), ("window", pa.int32()),
    ("formatted", pa.string()), ("n_repeated", pa.int32()),
    ("loss", pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))),
    ("n_tokens", pa.int32())])


class _Window:
    """One stream position: the window being filled and what later ones repeat."""

    def __init__(self, history: int, budget: int):
        self.budget, self.system = budget, None
        self.past: deque = deque(maxlen=history)
        self.turns: list[tuple[str, int, str, bool]] = []  # shown, tokens, role, new
        self.sum, self.number = 0, 0

    def open(self, tokens: int) -> None:
        room = self.system and self.system[1] + tokens <= self.budget
        self.turns = [(*self.system, False)] if room else []
        self.sum = sum(t[1] for t in self.turns)
        past = list(self.past)
        past = [t for t in past if t is not self.system]
        while past and self.sum + sum(t[1] for t in past) + tokens > self.budget:
            past = past[1:]
        self.turns += [(*t, False) for t in past]
        self.sum += sum(t[1] for t in past)

    def row(self, conv, block) -> tuple:
        text, loss, at = [], [], 0
        for shown, _, role, new in self.turns:
            if new and role == "assistant":
                stop = at + len(shown) - len(END) - 1
                loss.append({"start": at + shown.index(SEP) + len(SEP), "stop": stop})
            text.append(shown)
            at += len(shown)
        self.number += 1
        return (conv, block, self.number - 1, "".join(text),
                sum(not t[3] for t in self.turns), loss, self.sum)


def _format(batches: Iterator[pa.RecordBatch], path: str, pattern: str, budget: int, history: int
            ) -> Iterator[pa.RecordBatch]:
    count = token_counter(path, pattern)
    state, key, out = _Window(history, budget), None, []

    def table(rows):
        cols = list(zip(*rows))
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _ARROW)],
                                          schema=_ARROW)

    chars = 0
    for b in batches:
        for conv, block, kind, _, role, text in zip(*(c.to_pylist() for c in b.columns)):
            if (conv, block) != key:
                if state.turns and any(t[3] for t in state.turns):
                    out.append(state.row(*key))
                state, key = _Window(history, budget), (conv, block)
            shown = START + escape(role) + SEP + escape(text) + END + "\n"
            turn = (shown, count(shown), role)
            if kind == 0:
                state.system = turn
                continue
            if kind == 1:
                state.past.append(turn)
                continue
            if not any(t[3] for t in state.turns):
                state.open(turn[1])
            elif state.sum + turn[1] > budget:
                out.append(state.row(*key))
                chars += len(out[-1][3])
                state.open(turn[1])
            state.turns.append((*turn, True))
            state.sum += turn[1]
            if kind == 2:  # the conversation's system turn itself
                state.system = turn
            state.past.append(turn)
            if len(out) >= 2000 or chars > 16_000_000:
                yield table(out)
                out, chars = [], 0
    if any(t[3] for t in state.turns):
        out.append(state.row(*key))
    if out:
        yield table(out)


def format_chats(conversations: DataFrame, tokens_path: str, pattern: str, budget: int = 1024,
                 history: int = 2) -> DataFrame:
    """Windows (conv_id, block, window, formatted, n_repeated, loss, n_tokens)
    of ``conversations`` (conv_id, turn, role, text).  ``n_repeated`` leading
    turns repeat earlier ones; ``loss`` spans are code points of ``formatted``;
    ``n_tokens`` is the sum over its turns, each read as ordinary text."""
    rows = conversations.select(
        "conv_id", F.coalesce(F.floor(F.col("turn") / BLOCK), F.lit(-1 << 40)).alias("block"),
        "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    # the first turn of each conversation, where it is a system turn
    first = (rows.groupBy("conv_id").agg(F.min(F.struct("turn", "role", "text")).alias("f"))
             .filter("f.role = 'system'").select(F.col("conv_id").alias("_c"), "f.*"))
    is_first = (F.col("conv_id").eqNullSafe(F.col("_c")) & F.col("turn").eqNullSafe(F.col("_t"))
                & (F.col("role") == "system"))
    heads = first.select("_c", F.col("turn").alias("_t"))
    new = rows.join(heads, is_first, "left").select(
        *rows.columns, F.when(F.col("_t").isNull() & F.col("_c").isNull(), 3).otherwise(2).alias("kind"))
    blocks = rows.select("conv_id", "block").distinct()
    carried = first.withColumn("_b", F.coalesce(F.floor(F.col("turn") / BLOCK), F.lit(-1 << 40)))
    system = blocks.join(carried, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("block") > F.col("_b"))
                         ).select("conv_id", "block", "turn", "role", "text", F.lit(0).alias("kind"))
    past = rows.filter(F.pmod("turn", F.lit(BLOCK)) >= BLOCK - history).select(
        "conv_id", (F.col("block") + 1).alias("block"), "turn", "role", "text", F.lit(1).alias("kind"))
    dealt = (new.unionByName(system).unionByName(past)
             .select("conv_id", "block", F.when(F.col("kind") > 2, 2).otherwise(F.col("kind")).alias("_k"),
                     "kind", "turn", "role", "text")
             .repartition("conv_id", "block")
             .sortWithinPartitions("conv_id", "block", "_k", "turn", "role", "text")
             .select("conv_id", "block", "kind", "turn", "role", "text"))
    return dealt.mapInArrow(
        lambda it: _format(it, tokens_path, pattern, budget, history), WINDOW_SCHEMA)


DIGEST_SCHEMA = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
                 "loss_sha256 string, formatted_chars long, n_windows long")


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in DIGEST_SCHEMA.split(", ")]
    key, row, turns, loss, out = None, None, None, None, []

    def close():
        row[2], row[4] = turns.hexdigest(), loss.hexdigest()
        return row

    def table(rows):
        cols = dict(zip(names, zip(*rows)))
        return pa.RecordBatch.from_pydict({n: pa.array(c, pa.string() if "sha" in n else pa.int64())
                                           for n, c in cols.items()})

    for b in batches:
        for conv, text, repeated, spans in zip(*(c.to_pylist() for c in b.columns)):
            if row is None or conv != key:
                if row is not None:
                    out.append(close())
                key, row = conv, [conv, 0, "", 0, "", 0, 0]
                turns, loss = hashlib.sha256(), hashlib.sha256()
            new = read_turns(text)[repeated:]
            for role, said in new:
                turns.update(f"{role}\n{said}\n".encode())
            for s in spans:
                said = unescape(text[s["start"]:s["stop"]])
                loss.update(said.encode())
                row[3] += len(said)
            row[1] += len(new)
            row[5] += len(text)
            row[6] += 1
        if len(out) >= 5000:
            yield table(out)
            out = []
    if row is not None:
        out.append(close())
    if out:
        yield table(out)


def read_back(windows: DataFrame) -> DataFrame:
    """Per conversation, what its formatted windows hold: turns, targets and
    sizes, read as one stream in order (a digest takes its text in order)."""
    return (windows.repartition("conv_id").sortWithinPartitions("conv_id", "block", "window")
            .select("conv_id", "formatted", "n_repeated", "loss").mapInArrow(_digest, DIGEST_SCHEMA))
