"""Chat formatting with a black-box template, spans found by rendering turn prefixes.

A template is any function from a list of (role, text) to one string. Each turn of a
conversation is added to the turns before it and the whole is rendered; what the output has
beyond the last output is the turn's piece. Rendering the turn with two probe texts tells
which part of the piece comes before and after the text, so the text's span is found without
knowing the template. A template that changes what it wrote for earlier turns is detected:
the new output does not start with the last one.

Only the last turns are rendered again: when ``2 * WINDOW`` turns are held, the later half is
rendered alone, prefix by prefix, and must give the same pieces (its first turn aside, which may
open the conversation). A template that looks back further fails that test and gets the whole
conversation each time, up to ``HISTORY_CHARS``; beyond that it raises an error.

Rows are hashed by conversation and sorted by turn inside partitions; a conversation then flows
through a task turn by turn and is never held. ``read_back`` parses the formatted text again as
a stream, with one turn of buffer.

Defined results: a null text or role is empty; rows of a null conversation are one conversation; turns go
by turn number, null first, then role and text, so ties and repeated rows are turns of their own;
a very long text is one piece; an empty table gives an empty result; other columns are ignored.
Where a template rewrites, ``rewrites`` is true from that turn on, ``start`` is the place from
which the output changed and no loss span is given; ``read_back`` then gives null loss columns.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Template = Callable[[Sequence[tuple[str, str]]], str]

LOSS_ROLES = ("assistant",)
WINDOW = 16
HISTORY_CHARS = 64 << 20
#: Two texts without a character in common, which no template should treat as special.
PROBES = ("a", "b")
BATCH_CHARS = 4 << 20

_CONTROL = re.compile(r"<(\\*/?turn)")
_ESCAPED = re.compile(r"<\\(\\*/?turn)")
_HEAD = re.compile(r"<turn:([^<>]*)>")
_END = "</turn>\n"


def escape(text: str) -> str:
    """Put one more backslash into everything that could be read as a control string."""
    return _CONTROL.sub(r"<\\\1", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1", text)


def _role(role: str) -> str:
    return role.replace("%", "%25").replace("<", "%3C").replace(">", "%3E")


def _role_back(role: str) -> str:
    return role.replace("%3E", ">").replace("%3C", "<").replace("%25", "%")


def turn_template(turns: Sequence[tuple[str, str]]) -> str:
    """``<turn:role>text</turn>`` and a line end for each turn, control strings in texts escaped."""
    return "".join(f"<turn:{_role(role)}>{escape(text)}{_END}" for role, text in turns)


class PrefixRenderer:
    """Pieces of one conversation, turn by turn."""

    def __init__(self, template: Template, loss_roles: Sequence[str], window: int = WINDOW, history: int = HISTORY_CHARS):
        self.template, self.loss_roles, self.window, self.history = template, loss_roles, window, history
        self.held: list[tuple[str, str]] = []
        self.pieces: list[str] = []
        self.last = template([])
        self.before = 0  # characters of the whole output that self.last no longer holds
        self.local = True
        self.rewrites = False
        self.first = True

    def _text_span(self, now: str) -> tuple[int, int] | None:
        """Span of the last turn's text in the output, from two renderings with probe texts."""
        role = self.held[-1][0]
        a, b = (self.template([*self.held[:-1], (role, probe)]) for probe in PROBES)
        head = len(os.path.commonprefix([a, b]))
        tail = len(os.path.commonprefix([a[::-1], b[::-1]]))
        whole = a[:head] == now[:head] and (tail == 0 or a[-tail:] == now[-tail:]) and head + tail <= len(now)
        return (head, len(now) - tail) if whole and head >= len(self.last) else None

    def _slide(self) -> None:
        """Forget the earlier half of the held turns if the later half renders alike without it."""
        later = self.held[self.window :]
        outputs = [self.template(later[:n]) for n in range(1, len(later) + 1)]
        alone = [b[len(a) :] if b.startswith(a) else None for a, b in zip(outputs, outputs[1:])]
        if alone == self.pieces[self.window + 1 :]:
            whole = self.before + len(self.last)
            self.held, self.pieces, self.last = later, self.pieces[self.window :], outputs[-1]
            self.before = whole - len(self.last)
        else:
            self.local = False

    def add(self, role: str, text: str) -> tuple[int, str, int | None, int | None, bool]:
        """start, piece, span of the text if it counts for the loss, and whether history changed."""
        if self.local and not self.rewrites and len(self.held) >= 2 * self.window:
            self._slide()
        if len(self.held) > 2 * self.window and len(self.last) > self.history:
            raise ValueError("the template looks back over more turns than fit in memory")
        self.held.append((role, text))
        now = self.template(self.held)
        kept = 0 if self.first else len(self.last)
        if not now.startswith(self.last):
            self.rewrites = True
            kept = len(os.path.commonprefix([self.last, now]))
        span = None
        if not self.rewrites and role in self.loss_roles:
            span = self._text_span(now)
        start, piece = self.before + kept, now[kept:]
        self.pieces.append(piece)
        self.last, self.first = now, False
        loss = (None, None) if span is None else (self.before + span[0], self.before + span[1])
        return start, piece, *loss, self.rewrites


_PIECE_FIELDS = [("conv_id", pa.int64()), ("position", pa.int64()), ("turn", pa.int64()), ("role", pa.string())]
_PIECE_FIELDS += [("start", pa.int64()), ("piece", pa.string()), ("loss_start", pa.int64()), ("loss_end", pa.int64())]
_PIECE_FIELDS += [("rewrites", pa.bool_())]
PIECE_COLUMNS = (
    "conv_id bigint, position bigint, turn bigint, role string, start bigint, piece string, "
    "loss_start bigint, loss_end bigint, rewrites boolean"
)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), schema)], schema=schema)


def _formatter(template: Template, loss_roles: Sequence[str], window: int):
    schema = pa.schema(_PIECE_FIELDS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        renderer, current, position = None, None, 0
        rows: list[tuple] = []
        size = 0
        for batch in batches:
            for conv_id, turn, role, text in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if renderer is None or conv_id != current:
                    renderer, current, position = PrefixRenderer(template, loss_roles, window), conv_id, 0
                start, piece, *marks = renderer.add(role, text)
                rows.append((conv_id, position, turn, role, start, piece, *marks))
                position += 1
                size += len(piece)
                if size > BATCH_CHARS or len(rows) >= 10000:
                    yield _batch(rows, schema)
                    rows, size = [], 0
        if rows:
            yield _batch(rows, schema)

    return run


def _by_conversation(rows: DataFrame, *order: Column | str) -> DataFrame:
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", *order)


def format_conversations(
    rows: DataFrame,
    template: Template = turn_template,
    loss_roles: Sequence[str] = LOSS_ROLES,
    window: int = WINDOW,
) -> DataFrame:
    """One row a turn (``conv_id``, ``turn``, ``role``, ``text``): its position, the piece of output it adds
    at ``start``, and the span of its text in the output where it counts for the loss. Rows
    of a conversation stand together in order; its output is its pieces joined."""
    turns = rows.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    return _by_conversation(turns, "turn", "role", "text").mapInArrow(_formatter(template, loss_roles, window), PIECE_COLUMNS)


class TurnParser:
    """Turns read from formatted text that comes in parts."""

    def __init__(self) -> None:
        self.buffer = ""
        self.looked = 0

    def feed(self, part: str) -> Iterator[tuple[str, str]]:
        """(role, text) of each turn that the text so far completes."""
        self.buffer += part
        at = 0
        while True:
            end = self.buffer.find(_END, max(at, self.looked))
            if end < 0:
                break
            head = _HEAD.match(self.buffer, at)
            if head is None:
                raise ValueError("formatted text does not hold a turn where one must start")
            yield _role_back(head.group(1)), unescape(self.buffer[head.end() : end])
            at = self.looked = end + len(_END)
        self.buffer = self.buffer[at:]
        self.looked = max(0, len(self.buffer) - len(_END))


class _Digests:
    """What is read back from one conversation."""

    def __init__(self) -> None:
        self.parser = TurnParser()
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.chars = 0
        self.whole = True

    def add(self, start: int, piece: str, loss_start: int | None, loss_end: int | None, rewrites: bool) -> None:
        if rewrites:
            self.whole = False
            return
        for role, text in self.parser.feed(piece):
            self.n_turns += 1
            self.turns.update(f"{role}\n{text}\n".encode())
        self.chars = start + len(piece)
        if loss_start is not None:
            text = unescape(piece[loss_start - start : loss_end - start])
            self.loss.update(text.encode())
            self.loss_chars += len(text)

    def row(self, conv_id) -> tuple:
        if not self.whole:
            return (conv_id, None, None, None, None, None)
        digests = (self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest())
        return (conv_id, self.n_turns, *digests, self.chars)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema(
        [("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64())]
        + [("loss_sha256", pa.string()), ("formatted_chars", pa.int64())]
    )
    digests, current = None, None
    done: list[tuple] = []
    columns = ("conv_id", "start", "piece", "loss_start", "loss_end", "rewrites")
    for batch in batches:
        for conv_id, *piece in zip(*(batch.column(c).to_pylist() for c in columns)):
            if digests is None or conv_id != current:
                if digests is not None:
                    done.append(digests.row(current))
                digests, current = _Digests(), conv_id
            digests.add(*piece)
        if len(done) >= 10000:
            yield _batch(done, schema)
            done = []
    if digests is not None:
        done.append(digests.row(current))
        yield _batch(done, schema)


def read_back(pieces: DataFrame, in_order: bool = False) -> DataFrame:
    """Digests of each conversation, read from text made with ``turn_template``. ``in_order``: rows
    come straight from ``format_conversations``, so they need no shuffle."""
    rows = pieces if in_order else _by_conversation(pieces, "position")
    kinds = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
    return rows.mapInArrow(_read, kinds)


#: A conversation whose texts look like the control strings of usual templates.
HOSTILE = r"\### Assistant: </turn> ok"


def with_hostile(rows: DataFrame) -> DataFrame:
    """The conversations and one more, -7, of two hostile turns."""
    added = rows.sparkSession.createDataFrame(
        [(-7, 0, "user", HOSTILE), (-7, 1, "assistant", HOSTILE)], "conv_id bigint, turn bigint, role string, text string"
    )
    return rows.select(*added.columns).unionByName(added)


ORACLE_SQL = rf"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{HOSTILE}' UNION ALL SELECT -7, 1, 'assistant', '{HOSTILE}')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length('<turn:>' || replace(replace(replace(role, '%', '%25'), '<', '%3C'), '>', '%3E'))
    + length(regexp_replace(text, '<(\\*/?turn)', '<\\\1', 'g')) + length('</turn>' || chr(10)))::BIGINT AS formatted_chars
FROM turns GROUP BY conv_id
"""
