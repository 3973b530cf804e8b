"""Conversations as one formatted string each, with typed content parts, a loss mask and an exact way back.

A message is a list of parts: text, image, audio or document. A visitor flattens it: texts are escaped and joined, every
other part becomes a placeholder, and the attachment that it stands for is recorded in order, with the tokens to which a
model will expand it. A turn is

    <|turn|>role<|body|>content<|end|>

and a conversation is its turns. Every control string of this template or of other common ones that stands inside a
role or text is broken by an escape: a backslash is doubled, and backslash and colon follow the first character of a
control string. As no control string holds a backslash, none is left, and read_back() restores the texts.

A turn is formatted by itself, in a map; the conversation is its segments in order, one row each, so that none is ever
gathered. The loss mask is spans of code points of the segment: the texts of assistants, without their placeholders.
read_back() streams a conversation's segments through one task, sorted by Spark: a digest has an order.

Null texts are empty, null roles the empty role, turns in the order of turn (null first), then role, then segment. Null
conversations are one conversation. Repeated rows are turns of their own. Null parts or a null list are nothing, a part
of an unknown type is an error. Texts may be of any length. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.cluster import saved, ship

TURN, BODY, END = "<|turn|>", "<|body|>", "<|end|>"
#: Order of the segments of a conversation.
ORDER = ("turn", "role", "segment")
#: A text of nothing but what must be escaped.
TRIAL = "</s>[INST] ok [/INST]"
#: Control strings of common chat templates; `<|` begins all of this one's.
CONTROL = ("<|", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
_BREAK = re.compile(r"\\|" + "|".join(f"{re.escape(c[0])}(?={re.escape(c[1:])})" for c in CONTROL))
_JOIN = re.compile(r"\\([\\:])")
PLACEHOLDERS = {"image": "<|image|>", "audio": "<|audio|>", "document": "<|document|>"}
_PLACE = re.compile("|".join(map(re.escape, PLACEHOLDERS.values())))

PART = "struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
SEGMENT = (
    "conv_id long, turn long, role string, segment string, chars long, loss array<struct<start:long,end:long>>, "
    "attachments array<struct<place:int,type:string,ref:string,at:long,tokens:long>>, expanded_tokens long"
)


@dataclass(frozen=True)
class Expansion:
    """To how many tokens placeholders expand: image patches of so many pixels with one token a row end, audio frames a
    second, tokens a page."""

    patch: int = 28
    most_patches: int = 16_384
    frames: float = 25.0
    page: int = 1_024


def escape(text: str) -> str:
    return _BREAK.sub(lambda m: "\\\\" if m[0] == "\\" else m[0] + "\\:", text)


def unescape(text: str) -> str:
    return _JOIN.sub(lambda m: "\\" if m[1] == "\\" else "", text)


@dataclass
class Flattened:
    """What a visitor makes of one message."""

    pieces: list[str] = field(default_factory=list)
    chars: int = 0
    texts: list[tuple[int, int]] = field(default_factory=list)  # spans of escaped text
    attachments: list[tuple[str, str | None, int, int]] = field(default_factory=list)  # type, ref, place in the content, tokens

    @property
    def content(self) -> str:
        return "".join(self.pieces)


class Visitor:
    """Flattens the parts of one message, in order. A part of type x goes to visit_x."""

    def __init__(self, expansion: Expansion):
        self.expansion, self.out, self._text = expansion, Flattened(), []

    def visit(self, part: dict) -> None:
        if (call := getattr(self, f"visit_{part['type']}", None)) is None:
            raise ValueError(f"no content part of type {part['type']!r}")
        call(part)

    def visit_text(self, part: dict) -> None:
        self._text.append(part["text"] or "")  # escaped once whole: control strings may cross parts

    def visit_image(self, part: dict) -> None:
        side = self.expansion.patch
        across, down = (max(1, math.ceil((part[x] or 0) / side)) for x in ("width", "height"))
        self._placeholder(part, min(across * down, self.expansion.most_patches) + down)

    def visit_audio(self, part: dict) -> None:
        self._placeholder(part, max(1, math.ceil((part["seconds"] or 0.0) * self.expansion.frames)))

    def visit_document(self, part: dict) -> None:
        self._placeholder(part, max(1, part["pages"] or 0) * self.expansion.page)

    def _append(self, piece: str) -> None:
        self.out.pieces.append(piece)
        self.out.chars += len(piece)

    def _flush(self) -> None:
        if text := escape("".join(self._text)):
            self.out.texts.append((self.out.chars, self.out.chars + len(text)))
            self._append(text)
        self._text = []

    def _placeholder(self, part: dict, tokens: int) -> None:
        self._flush()
        self.out.attachments.append((part["type"], part["ref"], self.out.chars, tokens))
        self._append(PLACEHOLDERS[part["type"]])

    def done(self) -> Flattened:
        self._flush()
        return self.out


def flatten(parts: list[dict], expansion: Expansion = Expansion()) -> Flattened:
    visitor = Visitor(expansion)
    for part in parts:
        if part is not None:
            visitor.visit(part)
    return visitor.done()


def parts_of(segment: str, attachments: list[dict]) -> tuple[str, list[dict]]:
    """(role, parts) of a segment; neighbouring texts are one part."""
    head, _, rest = segment.partition(TURN)[2].partition(BODY)
    content, parts, at = rest.removesuffix(END), [], 0
    for found, known in zip(_PLACE.finditer(content), attachments, strict=True):
        if found.start() > at:
            parts.append({"type": "text", "text": unescape(content[at : found.start()])})
        parts.append({"type": known["type"], "ref": known["ref"]})
        at = found.end()
    if len(content) > at:
        parts.append({"type": "text", "text": unescape(content[at:])})
    return unescape(head), parts


def _format_rows(expansion: Expansion):
    """Columns conv_id, turn, role, parts to those of SEGMENT."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {c: [] for c in ("segment", "chars", "loss", "attachments", "expanded_tokens")}
            for role, parts in zip(batch.column(2), batch.column(3), strict=True):
                flat = flatten(parts.as_py() or [], expansion)
                head = TURN + escape(role.as_py()) + BODY
                out["segment"].append(head + flat.content + END)
                out["chars"].append(len(out["segment"][-1]))
                out["loss"].append([{"start": len(head) + s, "end": len(head) + e} for s, e in flat.texts] if role.as_py() == "assistant" else [])
                out["attachments"].append([{"place": i, "type": t, "ref": r, "at": len(head) + at, "tokens": n} for i, (t, r, at, n) in enumerate(flat.attachments)])
                out["expanded_tokens"].append(sum(n for *_, n in flat.attachments))
            long = pa.int64()
            kinds = {
                "segment": pa.string(), "chars": long, "loss": pa.list_(pa.struct([("start", long), ("end", long)])),
                "attachments": pa.list_(pa.struct([("place", pa.int32()), ("type", pa.string()), ("ref", pa.string()), ("at", long), ("tokens", long)])), "expanded_tokens": long,
            }
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(3)), *(pa.array(out[c], kinds[c]) for c in out)], ["conv_id", "turn", "role", *out])

    return run


def text_parts(text_col: str = "text") -> Column:
    """A list of one text part."""
    values = {"type": F.lit("text"), "text": F.col(text_col).cast("string")}
    names = ("type", "text", "ref", "width", "height", "seconds", "pages")
    return F.array(F.struct(*[values.get(c, F.lit(None)).alias(c) for c in names])).cast(f"array<{PART}>")


def formatted(messages: DataFrame, parts_col: str | None = None, expansion: Expansion = Expansion(), conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The segments (columns of SEGMENT), one a message, whose content is a list of parts (as PART) or, without
    parts_col, a text. A conversation is its segments in the order of ORDER."""
    ship(messages.sparkSession)
    parts = F.col(parts_col).cast(f"array<{PART}>") if parts_col else text_parts(text_col)
    rows = messages.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"), parts.alias("parts"))
    return rows.mapInArrow(_format_rows(expansion), SEGMENT)


class _Conversation:
    """Digests of one conversation, segment after segment."""

    def __init__(self):
        self.turns = self.chars = self.loss_chars = self.attachments = self.tokens = 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, segment: str, loss: list[dict], attachments: list[dict], tokens: int) -> None:
        role, parts = parts_of(segment, attachments)
        text = "".join(p["text"] for p in parts if p["type"] == "text")
        self.turns += 1
        self.chars += len(segment)
        self.attachments += len(attachments)
        self.tokens += tokens
        self.all.update(f"{role}\n{text}\n".encode())
        for span in loss:
            under = unescape(segment[span["start"] : span["end"]])
            self.loss_chars += len(under)
            self.loss.update(under.encode())

    def row(self) -> tuple:
        return self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars, self.attachments, self.tokens


_READ = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_attachments long, expanded_tokens long"


def _read_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments, those of a conversation together and in order, to a row for each conversation."""
    names = [c.split()[0] for c in _READ.split(", ")]
    none = object()
    own, state = none, None

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, pa.string() if n.endswith("sha256") else pa.int64()) for n, c in zip(names, columns, strict=True)], names)

    for batch in batches:
        rows = []
        conv, segment, loss, attachments, tokens = (batch.column(c) for c in ("conv_id", "segment", "loss", "attachments", "expanded_tokens"))
        for i, c in enumerate(conv.to_pylist()):
            if state is None or c != own:
                if state is not None:
                    rows.append((own, *state.row()))
                own, state = c, _Conversation()
            state.add(segment[i].as_py(), loss[i].as_py(), attachments[i].as_py(), tokens[i].as_py())
        if rows:
            yield batch_of(rows)
    if state is not None:
        yield batch_of([(own, *state.row())])


def read_back(segments: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256 (of role, line end, text, line end of every turn), loss_chars and loss_sha256 (of the
    texts under the loss mask), formatted_chars, n_attachments and expanded_tokens of every conversation, from its
    segments alone."""
    ship(segments.sparkSession)
    rows = segments.select("conv_id", "turn", "role", "segment", "loss", "attachments", "expanded_tokens")
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", *ORDER).mapInArrow(_read_rows, _READ)


def round_trip(messages: DataFrame) -> DataFrame:
    """read_back() of messages (conv_id, turn, role, text) and of one conversation more, -1, whose texts are control strings."""
    spark = messages.sparkSession
    more = spark.createDataFrame([(-1, 0, "user", TRIAL), (-1, 1, "assistant", TRIAL)], "conv_id long, turn long, role string, text string")
    rows = messages.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text").unionByName(more)
    return read_back(saved(formatted(rows), "segments"))
