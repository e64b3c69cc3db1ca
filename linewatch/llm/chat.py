"""Chat formatting: typed content parts, flattened by a visitor into one string per turn.

Template: ``<turn:ROLE>`` BODY ``</turn>`` and a line break. Texts and roles are escaped so that no ``<`` or ``>`` of theirs
is left; a backslash, ``<`` and ``>`` become ``\\\\\\\\``, ``\\\\l`` and ``\\\\g``, which reads back without loss. Images, audio and
documents leave placeholders ``<image:0>``, ``<audio:1>``, ``<document:2>``, numbered in order within the turn.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_ESCAPED = {"\\": "\\\\", "<": "\\l", ">": "\\g"}
_PLAIN = {v: k for k, v in _ESCAPED.items()}
_TO_ESCAPE = re.compile(r"[\\<>]")
_TO_READ = re.compile(r"\\[\\lg]")
_TURN = re.compile(r"<turn:([^<>]*)>(.*?)</turn>\n", re.DOTALL)
_PLACEHOLDER = re.compile(r"<(?:image|audio|document):\d+>")


def escape(text: str) -> str:
    return _TO_ESCAPE.sub(lambda m: _ESCAPED[m[0]], text)


def unescape(text: str) -> str:
    return _TO_READ.sub(lambda m: _PLAIN[m[0]], text)


@dataclass(frozen=True)
class Part:
    """``kind``: text, image, audio or document. Sizes are those of the kind; ``ref`` names the attachment."""

    kind: str
    text: str = ""
    ref: str = ""
    width: int = 0
    height: int = 0
    seconds: float = 0.0
    pages: int = 0


PART_TYPE = "struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"


@dataclass(frozen=True)
class Expansion:
    """Tokens that an attachment stands for: image patches of a side, audio per second, documents per page."""

    patch: int = 28
    audio_per_second: float = 25.0
    per_page: int = 256


@dataclass
class Flattener:
    """Visits parts in order; builds the body, the attachments and the text's places in it."""

    expansion: Expansion
    pieces: list[str] = field(default_factory=list)
    attachments: list[dict] = field(default_factory=list)
    spans: list[tuple[int, int]] = field(default_factory=list)
    length: int = 0

    def visit(self, part: Part) -> None:
        handler = getattr(self, f"visit_{part.kind}", None)
        if handler is None:
            raise ValueError(f"no part of kind {part.kind!r}")
        handler(part)

    def _add(self, piece: str) -> None:
        self.pieces.append(piece)
        self.length += len(piece)

    def visit_text(self, part: Part) -> None:
        start = self.length
        self._add(escape(part.text))
        if self.length > start:
            self.spans.append((start, self.length))

    def _attach(self, part: Part, tokens: int) -> None:
        index = len(self.attachments)
        self.attachments.append({"index": index, "kind": part.kind, "ref": part.ref, "tokens": tokens})
        self._add(f"<{part.kind}:{index}>")

    def visit_image(self, part: Part) -> None:
        side = self.expansion.patch
        self._attach(part, math.ceil(part.width / side) * math.ceil(part.height / side))

    def visit_audio(self, part: Part) -> None:
        self._attach(part, math.ceil(part.seconds * self.expansion.audio_per_second))

    def visit_document(self, part: Part) -> None:
        self._attach(part, part.pages * self.expansion.per_page)


def format_turn(role: str, parts: list[Part], expansion: Expansion = Expansion()) -> tuple[str, list[dict], list[tuple[int, int]]]:
    """(string of the turn, attachments, places of its text in the string)."""
    visitor = Flattener(expansion)
    for part in parts:
        visitor.visit(part)
    head = f"<turn:{escape(role)}>"
    body = "".join(visitor.pieces)
    return f"{head}{body}</turn>\n", visitor.attachments, [(s + len(head), e + len(head)) for s, e in visitor.spans]


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn; attachments leave nothing."""
    return [(unescape(r), unescape(_PLACEHOLDER.sub("", b))) for r, b in _TURN.findall(formatted)]


FORMATTED = (
    "formatted string, attachments array<struct<index:int,kind:string,ref:string,tokens:bigint>>, tokens bigint, "
    "loss array<struct<start:int,end:int>>"
)


def _part(row: dict | None) -> Part:
    row = {k: v for k, v in (row or {}).items() if v is not None}
    return Part(**{"kind": "text", **row})


def format_conversations(
    turns: DataFrame, trained: tuple[str, ...] = ("assistant",), expansion: Expansion = Expansion()
) -> DataFrame:
    """conv_id, turn, nth, formatted, offset, attachments, tokens, loss: one row per turn.

    ``turns`` has conv_id, turn, role and either ``parts`` (an array of typed parts) or ``text``. A conversation's string is its rows'
    ``formatted`` by ``nth``; ``offset`` is where a row begins in it. ``loss`` are the places, within the row, of the
    text of ``trained`` roles. Null texts, parts and roles are empty; a part without a kind is text. Turns of one number go by role and string, so
    repeated rows are turns of their own. Rows of a null conv_id are one conversation."""
    typed = "parts" in turns.columns
    content = F.col("parts") if typed else F.array(F.struct(F.lit("text").alias("kind"), F.col("text")))
    kinds = {c: turns.schema[c].dataType.simpleString() for c in ("conv_id", "turn")}

    def rendered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [
                format_turn(role or "", [_part(p) for p in parts or []], expansion)
                for role, parts in zip(batch.column("role").to_pylist(), batch.column("content").to_pylist())
            ]
            roles = batch.column("role").to_pylist()
            loss = [[{"start": s, "end": e} for s, e in o[2]] if r in trained else [] for r, o in zip(roles, out)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("conv_id"),
                    batch.column("turn"),
                    pa.array(roles, pa.string()),
                    pa.array([o[0] for o in out], pa.string()),
                    pa.array(
                        [o[1] for o in out],
                        pa.list_(pa.struct([("index", pa.int32()), ("kind", pa.string()), ("ref", pa.string()), ("tokens", pa.int64())])),
                    ),
                    pa.array([sum(a["tokens"] for a in o[1]) for o in out], pa.int64()),
                    pa.array(loss, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                ],
                names=["conv_id", "turn", "role", "formatted", "attachments", "tokens", "loss"],
            )

    made = turns.select("conv_id", "turn", "role", content.alias("content")).mapInArrow(
        rendered, f"conv_id {kinds['conv_id']}, turn {kinds['turn']}, role string, {FORMATTED}"
    )
    # Only lengths are summed over a conversation; a long one streams through its window.
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "formatted")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    placed = made.withColumn("nth", (F.row_number().over(order) - 1).cast("bigint"))
    offset = F.coalesce(F.sum(F.char_length("formatted")).over(before), F.lit(0)).cast("bigint")
    return placed.withColumn("offset", offset).select(
        "conv_id", "turn", "nth", "formatted", "offset", "attachments", "tokens", "loss"
    )


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per conversation of a stream of rows by (conv_id, nth): digests are sequential, so a conversation
    is one task's work, a batch at a time."""
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "tokens"]
    open_, kind = None, None

    def close(state):
        conv, n, turns, chars, loss, total, tokens = state
        return (conv, n, turns.hexdigest(), chars, loss.hexdigest(), total, tokens)

    def table(rows):
        columns = list(zip(*rows)) if rows else [[] for _ in names]
        types = [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    for batch in batches:
        kind = batch.schema.field("conv_id").type
        done = []
        columns = [batch.column(c).to_pylist() for c in ("conv_id", "formatted", "loss", "tokens")]
        for conv, formatted, loss, tokens in zip(*columns):
            if open_ is None or open_[0] != conv:
                if open_ is not None:
                    done.append(close(open_))
                open_ = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
            for role, text in read_turns(formatted):
                open_[1] += 1
                open_[2].update(f"{role}\n{text}\n".encode())
            for s in loss:
                text = unescape(formatted[s["start"] : s["end"]])
                open_[3] += len(text)
                open_[4].update(text.encode())
            open_[5] += len(formatted)
            open_[6] += tokens
        if done:
            yield table(done)
    if open_ is not None:
        yield table([close(open_)])


def digest(formatted: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, tokens, all read back from
    the formatted strings."""
    kind = formatted.schema["conv_id"].dataType.simpleString()
    rows = formatted.select("conv_id", "nth", "formatted", "loss", "tokens")
    return (
        rows.repartition("conv_id")
        .sortWithinPartitions("conv_id", "nth")
        .mapInArrow(
            _fold,
            f"conv_id {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
            "formatted_chars bigint, tokens bigint",
        )
    )
