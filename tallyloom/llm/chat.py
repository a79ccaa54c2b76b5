"""Chat formatting in windows of a token budget."""

from __future__ import annotations

import hashlib
import re
from collections import deque
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUDGET = 2048
HISTORY = 256
# A conversation is dealt out in stretches of so many turn numbers.
BLOCK_TURNS = 1024

# Fixed values of the template. Every turn stands between an opening and a closing
# mark; a backslash before it takes a character of a text out of the template.
OPEN = {"turn": "<turn>", "kept": "<kept>", "again": "<again>"}
CLOSE = {"turn": "</turn>\n", "kept": "</kept>\n", "again": "</again>\n"}
HEAD = "### "

_CONTROL = re.compile(r"[\\<#:]")
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_TURN = re.compile(
    r"<(turn|kept|again)>### ([^\\:]*(?:\\.[^\\:]*)*): ([^\\<]*(?:\\.[^\\<]*)*)</\1>\n", re.DOTALL
)


def escape(text: str) -> str:
    return _CONTROL.sub(lambda found: "\\" + found[0], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def tokens_in(text: str) -> int:
    """An estimate that needs no vocabulary: a token for every 4 bytes, one at least."""
    return max(1, -(-len(text.encode()) // 4))


def formatted(kind: str, role: str, text: str) -> tuple[str, int, int]:
    """A turn by the template, and where its text starts and ends in it."""
    head = f"{OPEN[kind]}{HEAD}{escape(role)}: "
    body = escape(text)
    return f"{head}{body}{CLOSE[kind]}", len(head), len(head) + len(body)


class Windows:
    """Turns of a stretch in order, in; windows out. Keeps one window and the history."""

    def __init__(self, budget: int, history: int) -> None:
        self.budget, self.history_budget = budget, history
        self.system: tuple[str, str] | None = None
        self.start(None)

    def start(self, system: tuple[str, str] | None) -> None:
        """A new stretch; `system` is the system turn of the conversation, if it lies before."""
        self.system, self.before = system, 0
        self.pending_system: tuple[str, str] | None = None
        self.past: deque[tuple[int, str, str]] = deque()
        self.span: list[tuple[str, str, int]] = []
        self.used = self.overhead()

    def overhead(self) -> int:
        repeated = sum(tokens_in(formatted("again", r, t)[0]) for _, r, t in self.past)
        kept = tokens_in(formatted("kept", *self.system)[0]) if self.system else 0
        return repeated + kept

    def add(self, role: str, text: str, is_system: bool) -> tuple[str, list[tuple[int, int]]] | None:
        """Takes a turn; gives the window that it no longer fits into."""
        size = tokens_in(formatted("turn", role, text)[0])
        done = None
        if self.span and self.used + size > self.budget:
            done = self.close()
            while self.past and self.overhead() + size > self.budget:
                self.past.popleft()
            self.used = self.overhead()
        self.span.append((role, text, size))
        self.used += size
        if is_system:
            self.pending_system = (role, text)
        return done

    def close(self) -> tuple[str, list[tuple[int, int]]] | None:
        """The window of the turns held. They become history, as far as it goes back."""
        if not self.span:
            return None
        parts, loss, at = [], [], 0
        repeated = [("again", role, text) for _, role, text in self.past]
        if self.system:
            repeated.insert(0, ("kept", *self.system))
        for kind, role, text in [*repeated, *(("turn", r, t) for r, t, _ in self.span)]:
            part, start, end = formatted(kind, role, text)
            if kind == "turn" and role == "assistant":
                loss.append((at + start, at + end))
            parts.append(part)
            at += len(part)
        for role, text, size in self.span:
            self.before += size
            if self.pending_system != (role, text):
                self.past.append((self.before - size, role, text))
        # a prefix sum at which a turn starts tells how far back it lies
        while self.past and self.before - self.past[0][0] > self.history_budget:
            self.past.popleft()
        if self.pending_system:
            self.system, self.pending_system = self.pending_system, None
        self.span, self.used = [], self.overhead()
        return "".join(parts), loss


def format_windows(
    conversations: DataFrame,
    budget: int = BUDGET,
    history: int = HISTORY,
    block_turns: int = BLOCK_TURNS,
) -> DataFrame:
    """conv_id, block, window, formatted and loss (start and end of each target).

    Turns in the order of their numbers are cut into windows of whole turns, of at
    most `budget` tokens; a turn that is longer by itself has a window of its own.
    Each window opens with the conversation's system turn, if its first turn is
    one, then repeats turns before the window that start at most `history` tokens
    back. Under the loss are the texts of assistant turns where they stand first,
    never where they are repeated.

    A conversation is dealt out in blocks of `block_turns` turn numbers and
    streamed, so that a very long one lies in many tasks and no task holds more
    than a window. What opens it is sent to each later block; history starts anew
    with a block.

    Null texts and roles are empty; a null turn comes first, equal turns are in the
    order of role and text, a null conv_id is a conversation of its own.
    """
    turns = conversations.select(
        F.coalesce("conv_id", F.lit(0)).alias("_c"),
        F.col("conv_id").isNull().alias("_n"),
        F.coalesce(F.floor(F.col("turn") / block_turns), F.lit(-(1 << 60))).cast("bigint").alias("block"),
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    conversation = ["_c", "_n"]
    opening = turns.groupBy(*conversation).agg(
        F.min(F.struct("block", "turn")).alias("first"), F.max("block").alias("last")
    )
    opening = opening.where(F.col("first.block") < F.col("last"))
    later = (
        turns.select(*conversation, "block")
        .join(opening.select(*conversation, "first"), conversation)
        .where(F.col("block") > F.col("first.block"))
        .select(*conversation, "block")
        .distinct()
    )
    systems = (
        turns.where("role = 'system'")
        .join(opening, conversation)
        .where(F.col("block").eqNullSafe(F.col("first.block")))
        .where(F.col("turn").eqNullSafe(F.col("first.turn")))
        .groupBy(*conversation)
        .agg(F.min(F.struct("role", "text")).alias("s"))
    )
    sent = later.join(systems, conversation, "left").select(
        *conversation,
        "block",
        F.lit(None).cast("bigint").alias("turn"),
        F.col("s.role").alias("role"),
        F.col("s.text").alias("text"),
        F.lit(0).alias("own"),
    )
    firsts = turns.withColumn("own", F.lit(1))

    def windows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state, key, number, seen = Windows(budget, history), None, 0, False

        def row(found: tuple[str, list[tuple[int, int]]]) -> tuple:
            nonlocal number
            number += 1
            spans = [{"start": a, "end": b} for a, b in found[1]]
            return (*key, number - 1, found[0], spans)

        for frame in frames:
            out = []
            columns = [frame[c] for c in ("_c", "_n", "block", "own", "role", "text")]
            for c, null, block, own, role, text in zip(*columns, strict=True):
                if (c, null, block) != key:
                    if key is not None and (found := state.close()):
                        out.append(row(found))
                    key, number, seen = (c, null, block), 0, False
                    state.start(None)
                if not own:
                    seen = True
                    state.start(None if role is None else (role, text))
                    continue
                opens = not seen and role == "system"
                seen = True
                if found := state.add(role, text, opens):
                    out.append(row(found))
            yield pd.DataFrame(out, columns=["_c", "_n", "block", "window", "formatted", "loss"])
        if key is not None and (found := state.close()):
            yield pd.DataFrame(
                [row(found)], columns=["_c", "_n", "block", "window", "formatted", "loss"]
            )

    return (
        firsts.unionByName(sent)
        .repartition(*conversation, "block")
        .sortWithinPartitions(*conversation, "block", "own", "turn", "role", "text")
        .mapInPandas(
            windows,
            "_c bigint, _n boolean, block bigint, window bigint, formatted string,"
            " loss array<struct<start int, end int>>",
        )
        .select(
            F.when(~F.col("_n"), F.col("_c")).alias("conv_id"), "block", "window", "formatted", "loss"
        )
    )


def read_turns(text: str) -> list[tuple[str, str, str]]:
    """(kind, role, text) of each turn of a window, unescaped."""
    return [(kind, unescape(role), unescape(body)) for kind, role, body in _TURN.findall(text)]


def digest(windows: DataFrame) -> DataFrame:
    """What windows say about each conversation, read from their text and mask alone.

    conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars.
    Repeated turns are marked as such by the template and don't count. A digest
    goes over a conversation in order; it is streamed, one window at a time.
    """
    conversation = ["_c", "_n"]

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["_c", "_n", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        key = None
        turns, loss, counts = hashlib.sha256(), hashlib.sha256(), [0, 0, 0]

        def row() -> tuple:
            return (*key, counts[0], turns.hexdigest(), counts[1], loss.hexdigest(), counts[2])

        for frame in frames:
            out = []
            columns = [frame[c] for c in ("_c", "_n", "formatted", "loss")]
            for c, null, text, spans in zip(*columns, strict=True):
                if (c, null) != key:
                    if key is not None:
                        out.append(row())
                    key = (c, null)
                    turns, loss, counts = hashlib.sha256(), hashlib.sha256(), [0, 0, 0]
                for kind, role, body in read_turns(text):
                    if kind == "turn":
                        counts[0] += 1
                        turns.update(f"{role}\n{body}\n".encode())
                for span in spans:
                    target = unescape(text[span["start"] : span["end"]])
                    counts[1] += len(target)
                    loss.update(target.encode())
                counts[2] += len(text)
            yield pd.DataFrame(out, columns=names)
        if key is not None:
            yield pd.DataFrame([row()], columns=names)

    return (
        windows.select(
            F.coalesce("conv_id", F.lit(0)).alias("_c"),
            F.col("conv_id").isNull().alias("_n"),
            "block",
            "window",
            "formatted",
            "loss",
        )
        .repartition(*conversation)
        .sortWithinPartitions(*conversation, "block", "window")
        .mapInPandas(
            read,
            "_c bigint, _n boolean, n_turns bigint, turns_sha256 string, loss_chars bigint,"
            " loss_sha256 string, formatted_chars bigint",
        )
        .select(
            F.when(~F.col("_n"), F.col("_c")).alias("conv_id"),
            "n_turns",
            "turns_sha256",
            "loss_chars",
            "loss_sha256",
            "formatted_chars",
        )
    )
