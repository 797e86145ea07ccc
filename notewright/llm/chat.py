"""Conversations formatted as training windows of a bounded number of tokens, with a loss mask.

A running sum of a conversation's turn tokens cuts it into stretches of ``STRETCH`` budgets, each handled by
itself, so that a conversation of any length spreads over tasks and no task formats more than a window of it. Within
a stretch the sums choose spans of whole turns that fit the budget. Each window starts with the latest system turn
before it and with the last turns before it, across the borders of stretches too, as far as ``history_turns``,
``history_tokens`` and the budget allow; these repeated turns are masked. The loss covers the text of assistant turns
where they first appear, so each assistant text is a target once.

The budget is kept by leaving out history first. A turn that does not fit beside the system turn has a window without
it, and ``system_cut`` says so; the windows after it have it again. Only a turn that is by itself above the budget makes
a window above it, of that turn alone.

Turns are marked with ``### role: `` and ``</turn>``. Inside roles and texts a backslash stands before every
backslash, number sign and less-than sign, in roles also before a colon, so no mark can occur in them and the text
comes back as it was.

Turns go by ``turn``, ties by role and text; a null role or text is empty, a null conversation id is a
conversation of its own kind, repeated rows are turns of their own. No rows give no windows.
"""

from __future__ import annotations

import hashlib
import re
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from notewright.llm.base import column_rows, ready, row_batches
from notewright.session import shuffle_partitions

# Fixed values of the template.
OPEN, MIDDLE, CLOSE = "### ", ": ", "</turn>\n"
SYSTEM, TARGET = "system", "assistant"
TURN = re.compile(r"### ((?:[^\\:]|\\.)*): ((?:[^\\<]|\\.)*)</turn>\n", re.DOTALL)

BUDGET = 1024
HISTORY_TURNS = 2
HISTORY_TOKENS = 256
STRETCH = 64
# A token is a run of letters and digits or another character that is no space; a turn's marks count as MARKS.
TOKEN = r"[\p{L}\p{M}\p{N}]+|[^\s\p{L}\p{M}\p{N}]"
MARKS = 4

WINDOWS_DDL = (
    "conv_id bigint, stretch bigint, window int, n_repeated int, system_cut boolean, tokens bigint, text string, "
    "loss array<struct<start:int,end:int>>"
)
WINDOWS = pa.schema([
    ("conv_id", pa.int64()), ("stretch", pa.int64()), ("window", pa.int32()), ("n_repeated", pa.int32()),
    ("system_cut", pa.bool_()), ("tokens", pa.int64()), ("text", pa.string()),
    ("loss", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
])
DIGESTS_DDL = (
    "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
    "formatted_chars bigint"
)
DIGESTS = pa.schema([
    ("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
    ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
])


def escape(text: str) -> str:
    return re.sub(r"([\\#<])", r"\\\1", text)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


def with_sums(conversations: DataFrame, budget: int, history_turns: int = HISTORY_TURNS) -> DataFrame:
    """``(conv_id, place, role, text, tokens, stretch, opening, history)``: the turns in order and the stretch that the
    sum of tokens before each gives; at the first turn of a later stretch the latest system turn before it, and the
    turns just before it, the last one first."""
    text = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(""))
    rows = conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), "turn", text("role").alias("role"), text("text").alias("text")
    ).withColumn("tokens", F.regexp_count("text", F.lit(TOKEN)).cast("bigint") + F.lit(MARKS))
    ordered = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    so_far = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = ordered.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("place", F.row_number().over(ordered).cast("bigint"))
    before = F.sum("tokens").over(so_far) - F.col("tokens")
    rows = rows.withColumn("stretch", F.floor(before / F.lit(STRETCH * budget)).cast("bigint"))
    turn = F.struct("role", "text", "tokens")
    later = F.lag("stretch").over(ordered) < F.col("stretch")
    system = F.last(F.when(F.col("role") == SYSTEM, turn), ignorenulls=True).over(earlier)
    last = F.array(*[F.lag(turn, k).over(ordered) for k in range(1, history_turns + 1)])
    if not history_turns:
        last = F.array().cast("array<struct<role: string, text: string, tokens: bigint>>")
    return rows.withColumn("opening", F.when(later, system)).withColumn("history", F.when(later, last)).drop("turn")


Turn = tuple[str, str, int]


class Formatter:
    """Turns of one stretch in, windows out. A turn is ``(role, text, tokens)``."""

    def __init__(
        self, key: tuple, opening: Turn | None, history: list[Turn], budget: int, turns: int, tokens: int
    ) -> None:
        self.key, self.budget, self.most_tokens = key, budget, tokens
        self.window = 0
        self.system = opening
        self.recent: deque[Turn] = deque(history, maxlen=turns)
        self.repeated: list[Turn] = []
        self.cut = False
        self.fresh: list[Turn] = []

    def _open(self, turn: Turn) -> None:
        """What a window that begins with ``turn`` repeats before it."""
        room = self.budget - turn[2]
        self.cut = self.system is not None and self.system[2] > room
        head = [] if self.system is None or self.cut else [self.system]
        room = min(self.most_tokens, room - sum(t[2] for t in head))
        history: list[Turn] = []
        for old in reversed(self.recent):
            if old[0] == SYSTEM:
                continue  # the latest one stands at the head, an earlier one is replaced by it
            room -= old[2]
            if room < 0:
                break
            history.insert(0, old)
        self.repeated = head + history

    def add(self, turn: Turn) -> Iterator[tuple]:
        """Takes the next turn and yields the window that this closes, if it closes one."""
        if self.fresh and sum(t[2] for t in self.repeated + self.fresh) + turn[2] > self.budget:
            yield self.close()
        if not self.fresh:
            self._open(turn)
        self.fresh.append(turn)
        self.recent.append(turn)
        if turn[0] == SYSTEM:
            self.system = turn

    def close(self) -> tuple:
        parts, loss, at = [], [], 0
        for k, (role, text, _) in enumerate(self.repeated + self.fresh):
            lead = OPEN + escape(role).replace(":", "\\:") + MIDDLE
            body = escape(text)
            if k >= len(self.repeated) and role == TARGET and body:
                loss.append({"start": at + len(lead), "end": at + len(lead) + len(body)})
            parts.append(lead + body + CLOSE)
            at += len(parts[-1])
        tokens = sum(t[2] for t in self.repeated + self.fresh)
        row = (*self.key, self.window, len(self.repeated), self.cut, tokens, "".join(parts), loss)
        self.window += 1
        self.fresh = []
        return row


def format_windows(
    conversations: DataFrame, budget: int = BUDGET, history_turns: int = HISTORY_TURNS,
    history_tokens: int = HISTORY_TOKENS,
) -> DataFrame:
    """``(conv_id, stretch, window, n_repeated, system_cut, tokens, text, loss)``: the windows of all conversations.

    ``loss`` holds the code point spans of ``text`` that count; the first ``n_repeated`` turns are repeated ones.
    """
    spark = ready(conversations.sparkSession)
    rows = with_sums(conversations, budget, history_turns)
    rows = rows.repartition(shuffle_partitions(spark), "conv_id", "stretch")
    rows = rows.sortWithinPartitions("conv_id", "stretch", "place")

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        now = None
        turn = lambda held: held and (held["role"], held["text"], held["tokens"])
        for conv, stretch, role, text, tokens, opening, history in column_rows(
            batches, "conv_id", "stretch", "role", "text", "tokens", "opening", "history"
        ):
            if now is None or now.key != (conv, stretch):
                if now is not None:
                    yield now.close()
                last = [turn(held) for held in reversed(history or []) if held is not None]
                now = Formatter((conv, stretch), turn(opening), last, budget, history_turns, history_tokens)
            yield from now.add((role, text, tokens))
        if now is not None:
            yield now.close()

    return rows.mapInArrow(lambda batches: row_batches(windows(batches), WINDOWS, 256), WINDOWS_DDL)


def read_back(windows: DataFrame) -> DataFrame:
    """``(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars)`` from formatted text alone.

    Windows stream through one digest for each conversation, so a long one is never held as a whole.
    """
    spark = ready(windows.sparkSession)
    rows = windows.repartition(shuffle_partitions(spark), "conv_id")
    rows = rows.sortWithinPartitions("conv_id", "stretch", "window")

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        now, begun = None, False
        for conv, repeated, text, loss in column_rows(batches, "conv_id", "n_repeated", "text", "loss"):
            if not begun or now != conv:
                if begun:
                    yield now, n_turns, turns.hexdigest(), n_loss, target.hexdigest(), n_chars
                now, begun = conv, True
                n_turns = n_loss = n_chars = 0
                turns, target = hashlib.sha256(), hashlib.sha256()
            at = 0
            for k, turn in enumerate(TURN.finditer(text)):
                if turn.start() != at:
                    raise ValueError(f"window of conversation {conv} cannot be read back")
                at = turn.end()
                if k >= repeated:
                    n_turns += 1
                    turns.update(f"{unescape(turn[1])}\n{unescape(turn[2])}\n".encode())
            if at != len(text):
                raise ValueError(f"window of conversation {conv} cannot be read back")
            for span in loss:
                learned = unescape(text[span["start"]:span["end"]])
                n_loss += len(learned)
                target.update(learned.encode())
            n_chars += len(text)
        if begun:
            yield now, n_turns, turns.hexdigest(), n_loss, target.hexdigest(), n_chars

    return rows.mapInArrow(lambda batches: row_batches(digests(batches), DIGESTS), DIGESTS_DDL)
