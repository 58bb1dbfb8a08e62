"""Chat formatting in budgeted windows.

A turn is written as ``### Role: `` with its escaped text and ``</turn>``; in roles and texts the backslash and
the strings that mark turns are escaped, so the format can be read back exactly. Prefix sums of the turns'
tokens choose spans of whole turns: a window holds the conversation's leading system turns, then repeated
history of at most ``history`` tokens, then as many new turns as the budget leaves room for. History makes way
where the first new turn would not fit; a turn that is above the budget alone or with the system turns, which stay
whatever their length, gets a window of its own, marked over_budget. The loss mask covers the texts of assistant turns where they are new, so that each target counts
once however often it is repeated.

Conversations are dealt by conv_id and sorted by turn; a task reads them as a stream and holds one window, so a
conversation of any length needs no more memory. Turns with equal numbers are ordered by role and text;
repeated rows are turns of their own; a null text or role is empty; rows with a null conv_id form one
conversation; a null turn comes first; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waymark.llm.bpe import byte_bpe
from waymark.llm.common import grouped, small_batches, written

BUDGET, HISTORY = 1024, 256
TARGET_ROLE, SYSTEM_ROLE = "assistant", "system"
OPEN, COLON, CLOSE = "### ", ": ", "</turn>"

SPAN = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
WINDOWS = T.StructType(
    [T.StructField("conv_id", T.LongType()), T.StructField("window", T.LongType()), T.StructField("n_system", T.LongType()), T.StructField("n_history", T.LongType()), T.StructField("n_new", T.LongType())]
    + [T.StructField("n_tokens", T.LongType()), T.StructField("over_budget", T.BooleanType()), T.StructField("text", T.StringType()), T.StructField("loss_spans", T.ArrayType(SPAN))]
)
WINDOWS_ARROW = pa.schema(
    [("conv_id", pa.int64()), ("window", pa.int64()), ("n_system", pa.int64()), ("n_history", pa.int64()), ("n_new", pa.int64()), ("n_tokens", pa.int64()), ("over_budget", pa.bool_()), ("text", pa.string())]
    + [("loss_spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))]
)
DIGESTS = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("n_turns", T.LongType()), T.StructField("turns_sha256", T.StringType()), T.StructField("loss_chars", T.LongType()), T.StructField("loss_sha256", T.StringType()), T.StructField("formatted_chars", T.LongType()), T.StructField("n_windows", T.LongType())])
DIGESTS_ARROW = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("n_windows", pa.int64())])

ESCAPES = (("\\", "\\\\"), ("###", "\\#"), (CLOSE, "\\t"))
UNESCAPE = re.compile(r"\\(.)", re.S)
PLAIN = {"\\": "\\", "#": "###", "t": CLOSE, "c": ":", "n": "\n"}
TURN = re.compile(re.escape(OPEN) + r"([^:\n]*)" + re.escape(COLON) + r"(.*?)" + re.escape(CLOSE) + "\n", re.S)


def escape(text: str) -> str:
    for plain, written_as in ESCAPES:
        text = text.replace(plain, written_as)
    return text


def unescape(text: str) -> str:
    return UNESCAPE.sub(lambda found: PLAIN[found[1]], text)


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """The turn as written, and where its escaped text starts and ends."""
    head = OPEN + escape(role).replace(":", "\\c").replace("\n", "\\n") + COLON
    body = escape(text)
    return f"{head}{body}{CLOSE}\n", len(head), len(head) + len(body)


def parse_turns(text: str) -> Iterator[tuple[str, str, int, int]]:
    """Role, text, and the place of the escaped text, of each turn."""
    at = 0
    while at < len(text):
        found = TURN.match(text, at)
        if not found:
            raise ValueError("not a formatted conversation")
        yield unescape(found[1]), unescape(found[2]), found.start(2), found.end(2)
        at = found.end()


class Turn:
    __slots__ = ("end", "prefix", "role", "start", "text", "tokens")

    def __init__(self, role: str, text: str, tokens: int, start: int, end: int) -> None:
        self.role, self.text, self.tokens, self.start, self.end = role, text, tokens, start, end
        self.prefix = 0


def windows_of(turns: Iterator[Turn], budget: int, history: int) -> Iterator[tuple[list[Turn], list[Turn], list[Turn]]]:
    """Windows as (system turns, repeated history, new turns); prefix sums run over the turns after the system's."""
    system: list[Turn] = []
    past: deque[Turn] = deque()
    new: list[Turn] = []
    leading, system_tokens, total, first = True, 0, 0, True

    def past_for(room: int) -> list[Turn]:
        """The longest tail of the past of at most room tokens, by difference of prefix sums."""
        kept = [turn for turn in past if total - (turn.prefix - turn.tokens) <= room]
        return kept

    repeated: list[Turn] = []
    used = 0
    for turn in turns:
        if leading and turn.role == SYSTEM_ROLE:
            system.append(turn)
            system_tokens += turn.tokens
            continue
        leading = False
        if new and used + turn.tokens > budget:
            yield system, repeated, new
            first = False
            past.extend(new)
            while past and total - (past[0].prefix - past[0].tokens) > history:
                past.popleft()
            new = []
        if not new:
            repeated = past_for(min(history, budget - system_tokens - turn.tokens))
            used = system_tokens + sum(x.tokens for x in repeated)
        total += turn.tokens
        turn.prefix = total
        used += turn.tokens
        new.append(turn)
    if new or system and first:
        yield system, repeated, new


def _turns(rows: Iterator[tuple[str | None, str | None, int]]) -> Iterator[Turn]:
    for role, text, tokens in rows:
        formatted, start, end = format_turn(role or "", text or "")
        yield Turn(role or "", formatted, tokens, start, end)


def _format(batches: Iterator[pa.RecordBatch], path: str, budget: int, history: int) -> Iterator[pa.RecordBatch]:
    encoder = byte_bpe(path)

    def sized() -> Iterator[pa.RecordBatch]:
        for batch in batches:
            conv, role, text = (column.to_pylist() for column in batch.columns)
            written_turns = [format_turn(r or "", t or "")[0] for r, t in zip(role, text, strict=True)]
            sizes = [len(raw) // 4 for raw in encoder.encode_many(written_turns)]
            yield pa.RecordBatch.from_arrays([pa.array(conv, pa.int64()), pa.array(role, pa.string()), pa.array(text, pa.string()), pa.array(sizes, pa.int64())], names=["c", "r", "t", "n"])

    rows: list[dict] = []
    for conv_id, group in grouped(sized()):
        for number, (system, repeated, new) in enumerate(windows_of(_turns(group), budget, history)):
            parts, spans, at = [], [], 0
            for turn in [*system, *repeated, *new]:
                parts.append(turn.text)
                at += len(turn.text)
            at -= sum(len(turn.text) for turn in new)
            for turn in new:
                if turn.role == TARGET_ROLE:
                    spans.append({"start": at + turn.start, "end": at + turn.end})
                at += len(turn.text)
            tokens = sum(turn.tokens for turn in (*system, *repeated, *new))
            rows.append({"conv_id": conv_id, "window": number, "n_system": len(system), "n_history": len(repeated), "n_new": len(new), "n_tokens": tokens, "over_budget": tokens > budget, "text": "".join(parts), "loss_spans": spans})
            if len(rows) >= 500:
                yield pa.RecordBatch.from_pylist(rows, schema=WINDOWS_ARROW)
                rows = []
    if rows:
        yield pa.RecordBatch.from_pylist(rows, schema=WINDOWS_ARROW)


def format_conversations(spark: SparkSession, conversations: DataFrame, tokenizer: str, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """One row per window: its formatted text, loss spans over it (code points), and what it is made of."""
    small_batches(spark)
    rows = conversations.selectExpr("cast(conv_id as long) as conv_id", "turn", "role", "text")
    order = [F.col(name).asc_nulls_first() for name in ("conv_id", "turn", "role", "text")]
    ordered = rows.repartition("conv_id").sortWithinPartitions(*order).select("conv_id", "role", "text")
    return ordered.mapInArrow(lambda batches: _format(batches, tokenizer, budget, history), WINDOWS)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows: list[tuple] = []
    for conv_id, group in grouped(batches):
        turns, loss = hashlib.sha256(), hashlib.sha256()
        n_turns = loss_chars = formatted = n_windows = 0
        for number, n_system, n_history, text, spans in group:
            formatted += len(text)
            n_windows += 1
            masked = {(span["start"], span["end"]) for span in spans}
            for k, (role, plain, start, end) in enumerate(parse_turns(text)):
                if k >= n_system + n_history or number == 0 and k < n_system:
                    turns.update(f"{role}\n{plain}\n".encode())
                    n_turns += 1
                if (start, end) in masked:
                    loss.update(plain.encode())
                    loss_chars += len(plain)
        rows.append((conv_id, n_turns, turns.hexdigest(), loss_chars, loss.hexdigest(), formatted, n_windows))
        if len(rows) >= 5000:
            yield pa.RecordBatch.from_pylist([dict(zip(DIGESTS.names, row, strict=True)) for row in rows], schema=DIGESTS_ARROW)
            rows = []
    if rows:
        yield pa.RecordBatch.from_pylist([dict(zip(DIGESTS.names, row, strict=True)) for row in rows], schema=DIGESTS_ARROW)


def read_back(spark: SparkSession, windows: DataFrame) -> DataFrame:
    """Digests of what the windows hold, one row per conversation."""
    rows = windows.select("conv_id", "window", "n_system", "n_history", "text", "loss_spans")
    return rows.repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "window").mapInArrow(_digest, DIGESTS)


def conversation_digests(spark: SparkSession, conversations: DataFrame, tokenizer: str, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """Formats, writes the windows to the shared folder, and reads them back."""
    return read_back(spark, written(spark, format_conversations(spark, conversations, tokenizer, budget, history), "chat"))
