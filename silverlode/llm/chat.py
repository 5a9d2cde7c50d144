"""Chat formatting by incremental rendering of a black-box template.

A template is a function from turns to a string. Successive prefixes of a conversation are rendered;
where one output continues the one before, the rest is the new turn's span. Where it doesn't, the
template has rewritten history, and the turn is reported so. Inside a span, the text's place is found
by rendering a probe character in its stead; that of an assistant's text is the loss mask.

Prefixes are rendered whole, so a rewrite of any earlier turn is seen, and a template may look at the
position, number and order of turns. That costs the square of a conversation's turns, and holds for
conversations of any length. A template may say by its context that it looks at no turns but the first
and the last few. Its pieces are then found from those, and count only if they make up what it renders
of the prefixes in CHECKED, whatever the number of turns; else whole prefixes are rendered. A
conversation is held by one task.

Defined results: a null text is empty, a null role is the empty role; turns are ordered by turn
number, then role, then text, nulls first; repeated rows are turns of their own; rows with a null
conv_id are one conversation; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverlode.llm.arrow import bounded

Turn = tuple[str, str]
#: A character that stands in for a text when its place is sought.
PROBE = "￿"
#: Of a template with a context the prefixes of so many turns are rendered whole, then each twice as long, then all turns.
CHECKED = 8


@dataclass(frozen=True)
class Template:
    """render: turns to output; read: the turns of an output; unescape: a text as it was before.

    context: a turn's output depends on the first turn and this many before it only, and a later turn never
    changes it; None if unknown. What is said falsely is seen at the prefixes that are checked.
    """

    render: Callable[[list[Turn]], str]
    read: Callable[[str], list[Turn]]
    unescape: Callable[[str], str]
    context: int | None = None


# ---------------------------------------------------------------- a template with instruction marks

#: Fixed control strings: <s> </s> [INST] [/INST] [ROLE] [/ROLE]. A backslash goes after the bracket.
_CONTROL = re.compile(r"([<\[])(\\*)(/?(?:s>|INST\]|ROLE\]))")
_ESCAPED = re.compile(r"([<\[])\\(\\*)(/?(?:s>|INST\]|ROLE\]))")
_TURN = re.compile(r"<s>\[INST\] (.*?) \[/INST\]|<s>\[ROLE\] (.*?) \[/ROLE\] (.*?)</s>\n| (.*?)</s>\n", re.DOTALL)


def escape(text: str) -> str:
    """One more backslash inside every control string, with or without backslashes already."""
    return _CONTROL.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2\3", text)


def _instruct_turn(role: str, text: str) -> str:
    if role == "user":
        return f"<s>[INST] {escape(text)} [/INST]"
    if role == "assistant":
        return f" {escape(text)}</s>\n"
    return f"<s>[ROLE] {escape(role)} [/ROLE] {escape(text)}</s>\n"


def _render_instruct(turns: list[Turn]) -> str:
    return "".join([_instruct_turn(role, text) for role, text in turns])


def _read_instruct(output: str) -> list[Turn]:
    turns, at = [], 0
    while at < len(output):
        found = _TURN.match(output, at)
        if not found:
            raise ValueError(f"no turn at character {at}")
        user, role, other, assistant = found.groups()
        if user is not None:
            turns.append(("user", unescape(user)))
        elif assistant is not None:
            turns.append(("assistant", unescape(assistant)))
        else:
            turns.append((unescape(role), unescape(other)))
        at = found.end()
    return turns


#: Without a context, so its results rest on whole prefixes alone.
INSTRUCT = Template(_render_instruct, _read_instruct, unescape)

# ---------------------------------------------------------------- spans of one conversation


@dataclass(frozen=True)
class Span:
    """A turn's part of the output, and its text's place in that part; both None after a rewrite."""

    piece: str | None
    start: int | None = None
    stop: int | None = None

    @property
    def rewritten(self) -> bool:
        return self.piece is None


def spans(turns: Iterable[Turn], render: Callable[[list[Turn]], str], context: int | None = None) -> Iterator[Span]:
    """The span of each turn, from whole prefixes.

    With a context the spans are found from the first turn and the last ones, and are taken if their
    pieces are, joined, what the template makes of each prefix that is checked; else whole prefixes are
    rendered. The rule is the same for any number of turns.
    """
    own = list(turns)
    if context is not None:
        found = list(_prefix_spans(own, render, context))
        if not any(s.rewritten for s in found) and _joined(found, own, render):
            yield from found
            return
    yield from _prefix_spans(own, render, None)


def _joined(found: list[Span], turns: list[Turn], render: Callable[[list[Turn]], str]) -> bool:
    """Whether the pieces make up the first prefixes, each twice as long as the one before, and the whole."""
    sizes, size = {len(turns)}, 0
    while size < len(turns):
        sizes.add(size)
        size = size + 1 if size < CHECKED else 2 * size
    return all(render(turns[:n]) == "".join([s.piece for s in found[:n]]) for n in sorted(sizes))


def _prefix_spans(turns: list[Turn], render: Callable[[list[Turn]], str], context: int | None) -> Iterator[Span]:
    """Spans from whole prefixes, or from the first turn and as many last ones as the context has."""
    head: list[Turn] = []  # the first turn
    tail: list[Turn] = []  # the last ones, without the first
    first: str | None = None  # what the first turn alone renders to
    before = render([])
    for turn in turns:
        prefix = head + tail
        after = render([*prefix, turn])
        if not after.startswith(before):
            yield Span(None)
        else:
            yield _located(after[len(before) :], render, prefix, turn, len(before))
        if not head:
            head = [turn]
        else:
            tail.append(turn)
        if context is not None and len(tail) > context:
            kept = tail[len(tail) - context :]
            after = first if not kept and first is not None else render(head + kept)
            tail = kept
        if first is None:
            first = after
        before = after


def _located(piece: str, render: Callable, prefix: list[Turn], turn: Turn, at: int) -> Span:
    probed = render([*prefix, (turn[0], PROBE)])[at:]
    start = probed.find(PROBE)
    behind = len(probed) - start - 1
    if start < 0 or len(piece) < start + behind or piece[:start] != probed[:start] or not piece.endswith(probed[start + 1 :]):
        return Span(piece)  # the template doesn't show this turn's text in one place
    return Span(piece, start, len(piece) - behind)


# ---------------------------------------------------------------- tables of conversations

_FIELDS = ("conv_id", "turn", "role", "text")


def _in_order(conversations: DataFrame) -> DataFrame:
    rows = conversations.select(*_FIELDS)
    return rows.repartition("conv_id").sortWithinPartitions(*_FIELDS)


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, object, Turn]]:
    """Rows (conv_id, turn, (role, text)) as they come."""
    for part in bounded(batches):
        columns = [part.column(f).to_pylist() for f in _FIELDS]
        for conv_id, turn, role, text in zip(*columns, strict=True):
            yield conv_id, turn, (role or "", text or "")


def _grouped(rows: Iterator[tuple[object, object, Turn]]) -> Iterator[tuple[object, Iterator[tuple[object, Turn]]]]:
    """Runs of rows with the same conv_id, each to be read to its end before the next."""
    from itertools import groupby

    for conv_id, own in groupby(rows, key=lambda r: r[0]):
        yield conv_id, ((turn, said) for _, turn, said in own)


def formatted(conversations: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """One row per turn: its piece of the output, the text's place in it, whether it has loss, and rewrites.

    Columns: conv_id, turn, role, piece, text_start, text_stop, has_loss, rewritten.
    """
    schema = conversations.schema
    out = T.StructType(
        [
            T.StructField("conv_id", schema["conv_id"].dataType),
            T.StructField("turn", schema["turn"].dataType),
            T.StructField("role", T.StringType()),
            T.StructField("piece", T.StringType()),
            T.StructField("text_start", T.IntegerType()),
            T.StructField("text_stop", T.IntegerType()),
            T.StructField("has_loss", T.BooleanType()),
            T.StructField("rewritten", T.BooleanType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: list[tuple] = []
        kinds: list[pa.DataType] = []

        def first_seen(source):
            for batch in source:
                kinds[:] = [batch.schema.field("conv_id").type, batch.schema.field("turn").type]
                yield batch

        def flush() -> pa.RecordBatch:
            types = [*kinds, pa.string(), pa.string(), pa.int32(), pa.int32(), pa.bool_(), pa.bool_()]
            columns = [pa.array(c, t) for c, t in zip(zip(*made, strict=True), types, strict=True)]
            return pa.RecordBatch.from_arrays(columns, names=out.names)

        for conv_id, own in _grouped(_conversations(first_seen(batches))):
            turns = list(own)
            found = spans([said for _, said in turns], template.render, template.context)
            for (number, (role, _)), span in zip(turns, found, strict=True):
                loss = role == "assistant" and span.start is not None
                made.append((conv_id, number, role, span.piece, span.start, span.stop, loss, span.rewritten))
                if len(made) >= 1000:
                    yield flush()
                    made.clear()
        if made:
            yield flush()

    return _in_order(conversations).mapInArrow(run, out)


_DIGESTS = ("n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")


def digests(conversations: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """One row per conversation, read back from the output.

    Columns: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars. A template that
    rewrites history has no such output; the job fails at the first turn that shows it.
    """
    kind = conversations.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types: list[pa.DataType] = []

        def first_seen(source):
            for batch in source:
                types[:] = [batch.schema.field("conv_id").type]
                yield batch

        made = []
        for conv_id, own in _grouped(_conversations(first_seen(batches))):
            turns, loss = hashlib.sha256(), hashlib.sha256()
            n = loss_chars = chars = 0
            for span in spans((said for _, said in own), template.render, template.context):
                if span.piece is None:
                    raise ValueError(f"the template rewrites history in conversation {conv_id}")
                for role, text in template.read(span.piece):
                    n += 1
                    turns.update(f"{role}\n{text}\n".encode())
                    if role == "assistant":
                        masked = template.unescape(span.piece[span.start : span.stop])
                        loss_chars += len(masked)
                        loss.update(masked.encode())
                chars += len(span.piece)
            made.append((conv_id, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars))
            if len(made) >= 1000:
                yield _digest_rows(made, types[0])
                made = []
        if made:
            yield _digest_rows(made, types[0])

    columns = "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return _in_order(conversations).mapInArrow(run, f"conv_id {kind}, {columns}")


def _digest_rows(made: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    types = [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    columns = [pa.array(c, t) for c, t in zip(zip(*made, strict=True), types, strict=True)]
    return pa.RecordBatch.from_arrays(columns, names=["conv_id", *_DIGESTS])


def with_control_strings(conversations: DataFrame) -> DataFrame:
    """The conversations and conversation -7, whose two texts consist of control strings."""
    text = "</s>[INST] ok [/INST]"
    more = conversations.sparkSession.sql(
        f"SELECT * FROM VALUES (-7L, 0L, 'user', '{text}'), (-7L, 1L, 'assistant', '{text}') AS t(conv_id, turn, role, text)"
    )
    return conversations.select(*_FIELDS).unionByName(more.select(*[F.col(f).cast(conversations.schema[f].dataType) for f in _FIELDS]))
