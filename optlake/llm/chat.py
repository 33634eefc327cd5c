"""Chat formatting from an event log.

Events are folded per message: a ``start`` opens it (and carries the role), a
``delta`` appends to it, an ``edit`` replaces its text, a ``regenerate`` clears
it so that later deltas start anew.  Messages are hashed by (conversation,
turn, message), so a long conversation is folded by many tasks.  Rendering then
reads each conversation in order as a stream: one task holds one message at a
time, never a whole conversation.

Defined results: null text is empty, a null role is the empty role, a null
conversation id is a conversation of its own, null turns come first.  Events
with equal sequence numbers are ordered by kind (start, edit, regenerate,
delta) and payload.  A message that never got a ``start`` keeps the last
non-null role of its events, or the empty one.  Very long turns are read whole,
one at a time.  An empty log gives no rows.
Columns other than those named are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from optlake.llm.common import map_stream

START, END = "<|im_start|>", "<|im_end|>"
TRAINED_ROLE = "assistant"
EVENT_RANK = {"start": 0, "edit": 1, "regenerate": 2, "delta": 3}
PIECES = ("conv_id long, turn long, msg long, piece string, loss_start int, loss_end int")

_OPEN = re.compile(r"<(\\*)\|")
_SHUT = re.compile(r"<\\(\\*)\|")
_PIECE = re.compile(r"<\|im_start\|>(.*?)\n(.*?)<\|im_end\|>\n", re.DOTALL)


def escape(text: str) -> str:
    """One more backslash inside every ``<|``, ``<\\|``, ...: no control string is left, and it can be undone."""
    return _OPEN.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _SHUT.sub(r"<\1|", text)


def _role_out(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def _role_in(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def render(role: str, text: str) -> tuple[str, int, int]:
    """The piece of one turn and the code-point range of its trained text (empty unless the role is trained)."""
    head = f"{START}{_role_out(role)}\n"
    body = escape(text)
    end = len(head) + len(body) if role == TRAINED_ROLE else len(head)
    return f"{head}{body}{END}\n", len(head), end


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of every turn of a formatted string."""
    return [(_role_in(r), unescape(t)) for r, t in _PIECE.findall(formatted)]


def fold_messages(events: DataFrame) -> DataFrame:
    """Final message texts: one row per (conv_id, turn, msg).

    Takes conv_id, turn, msg, seq, op, role, payload.
    """
    rank = F.coalesce(*[F.when(F.col("op") == k, F.lit(v)) for k, v in EVENT_RANK.items()], F.lit(9))
    key = ["conv_id", "turn", "msg"]
    dealt = (events.select(*[F.col(k).cast("long").alias(k) for k in key], F.col("seq").cast("long").alias("seq"),
                           rank.alias("rank"), "role", F.coalesce("payload", F.lit("")).alias("payload"))
             .repartition(*key).sortWithinPartitions(*key, "seq", "rank", "payload"))

    def fold(rows: Iterator[tuple]) -> Iterator[tuple]:
        now, role, parts = None, "", []
        for conv, turn, msg, _, kind, who, payload in rows:
            if now != (conv, turn, msg):
                if now is not None:
                    yield (*now, role, "".join(parts))
                now, role, parts = (conv, turn, msg), "", []
            role = who if who is not None else role
            if kind in (0, 1):
                parts = [payload]
            elif kind == 2:
                parts = []
            elif kind == 3:
                parts.append(payload)
        if now is not None:
            yield (*now, role, "".join(parts))

    return map_stream(dealt, ["conv_id", "turn", "msg", "seq", "rank", "role", "payload"],
                      "conv_id long, turn long, msg long, role string, text string", fold)


def format_conversations(events: DataFrame) -> DataFrame:
    """Rendered turns: one row per turn with its piece and its trained range.

    Conversations are whole within a partition and ordered in it, so writing
    the partition's pieces one after another gives the formatted corpus.
    """
    def out(rows: Iterator[tuple]) -> Iterator[tuple]:
        for conv, turn, msg, role, text in rows:
            yield (conv, turn, msg, *render(role, text))

    rendered = map_stream(fold_messages(events), ["conv_id", "turn", "msg", "role", "text"], PIECES, out)
    return rendered.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "msg")


def read_back(pieces: DataFrame) -> DataFrame:
    """Digests per conversation, parsed from the rendered pieces in order."""
    def digest(rows: Iterator[tuple]) -> Iterator[tuple]:
        now, held = None, None
        for conv, piece, a, b in rows:
            if held is None or now != conv:
                if held is not None:
                    yield close(now, held)
                now, held = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            for role, text in parse(piece):
                held[0] += 1
                held[1].update(f"{role}\n{text}\n".encode())
            trained = unescape(piece[a:b])
            held[2] += len(trained)
            held[3].update(trained.encode())
            held[4] += len(piece)
        if held is not None:
            yield close(now, held)

    def close(conv, held):
        return conv, held[0], held[1].hexdigest(), held[2], held[3].hexdigest(), held[4]

    return map_stream(pieces, ["conv_id", "piece", "loss_start", "loss_end"],
                      "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
                      "formatted_chars long", digest)


def events_of_turns(turns: DataFrame) -> DataFrame:
    """The event log of finished turns: a start and two deltas for each row.

    Rows that share a turn are messages of their own, by role and text; a
    repeated row is one more message.
    """
    text = F.coalesce("text", F.lit(""))
    same = Window.partitionBy("conv_id", "turn").orderBy("role", "text")
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), text.alias("text"))
    log = """inline(array(
        named_struct('seq', 0, 'op', 'start', 'payload', ''),
        named_struct('seq', 1, 'op', 'delta', 'payload', left(text, length(text) div 2)),
        named_struct('seq', 2, 'op', 'delta', 'payload', substring(text, length(text) div 2 + 1))))"""
    numbered = rows.withColumn("msg", F.row_number().over(same))  # before the rows are multiplied
    return numbered.select("conv_id", "turn", "msg", "role", F.expr(log))
