"""Chat formatting with typed content parts.

A turn's content is a list of parts. ``Visitor`` has a method per type: text is escaped and kept;
image, audio and document parts become one placeholder each, in order, and are recorded as
attachments (type, reference, place in the output, tokens the placeholder expands to). The template
is ``<|im_start|>role\\n content <|im_end|>\\n`` without the blanks.

Escaping is reversible: ``\\`` becomes ``\\\\`` and ``|`` becomes ``\\|`` inside texts (and a line break
``\\n`` inside roles), so no text can hold ``<|``. The loss mask has the spans of assistant texts,
counted in code points of the turn's output.

Formatting is a map over turns, one output row each, so no task holds a conversation. ``digest``
reads the output back in order of turns: a shuffle by conversation, then a stream through each
partition that keeps running hashes and no text, so a conversation of any length takes no memory.

Rows: null text and null parts are empty; a null role is empty; unknown part types are kept as
attachments of that type; turns of one number go by role, then output; null conversation ids form
one conversation; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
ASSISTANT = "assistant"
TILE_TOKENS, SECOND_TOKENS, PAGE_TOKENS = 256, 25, 512  # an image's tile, audio's second, a page

PART = "struct<type:string,text:string,ref:string,units:bigint>"
ATTACHMENTS = "array<struct<type:string,ref:string,at:bigint,tokens:bigint>>"
TURNS = ("conv_id bigint, turn bigint, formatted string, mask array<struct<start:bigint,stop:bigint>>, "
         f"attachments {ATTACHMENTS}, attached_tokens bigint")
DIGEST = ("conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
          "formatted_chars bigint, n_attachments bigint")

_TURN = re.compile(r"<\|im_start\|>((?:[^\\\n|]|\\.)*)\n(.*)<\|im_end\|>\n", re.S)
_PLACEHOLDER = re.compile(r"<\|[a-z_]+\|>")


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("|", "\\|")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S) if "\\" in text else text


def escape_role(role: str) -> str:
    return escape(role).replace("\n", "\\n")


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], role, flags=re.S) if "\\" in role else role


class Visitor:
    """Flattens one turn's parts."""

    def __init__(self, role: str):
        self.out = [START, escape_role(role), "\n"]
        self.at = sum(map(len, self.out))
        self.assistant = role == ASSISTANT
        self.mask: list[tuple[int, int]] = []
        self.attachments: list[dict] = []

    def _put(self, s: str) -> None:
        self.out.append(s)
        self.at += len(s)

    def visit(self, part: dict) -> None:
        kind = part["type"] or "text"
        getattr(self, f"visit_{kind}", self.visit_other)(part)

    def visit_text(self, part: dict) -> None:
        start = self.at
        self._put(escape(part["text"] or ""))
        if self.assistant and self.at > start:
            self.mask.append((start, self.at))

    def visit_image(self, part: dict) -> None:
        self._attach("image", part, TILE_TOKENS)

    def visit_audio(self, part: dict) -> None:
        self._attach("audio", part, SECOND_TOKENS)

    def visit_document(self, part: dict) -> None:
        self._attach("document", part, PAGE_TOKENS)

    def visit_other(self, part: dict) -> None:
        self._attach(re.sub("[^a-z_]", "_", part["type"].lower()), part, 1)

    def _attach(self, kind: str, part: dict, tokens: int) -> None:
        n = max(1, part["units"] if part["units"] is not None else 1)
        self.attachments.append({"type": kind, "ref": part["ref"], "at": self.at, "tokens": n * tokens})
        self._put(f"<|{kind}|>")

    def close(self) -> str:
        self._put(END + "\n")
        return "".join(self.out)


def text_part(text: Column) -> Column:
    """A turn's parts when it has a text only."""
    null = F.lit(None)
    return F.array(F.struct(F.lit("text").alias("type"), text.cast("string").alias("text"),
                            null.cast("string").alias("ref"), null.cast("bigint").alias("units")))


def format_turns(df: DataFrame, parts: Column | None = None) -> DataFrame:
    """``TURNS``: each row of ``df`` (conv_id, turn, role, text) formatted; ``parts`` is an array of
    ``PART`` (the text, if not given)."""
    content = text_part(F.col("text")) if parts is None else parts.cast(f"array<{PART}>")
    turns = df.select(F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
                      F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), content.alias("parts"))
    mask_type = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
    attached_type = pa.list_(pa.struct([("type", pa.string()), ("ref", pa.string()), ("at", pa.int64()), ("tokens", pa.int64())]))

    def run(batches):
        for batch in batches:
            texts, masks, attached = [], [], []
            for i in range(batch.num_rows):
                v = Visitor(batch.column(2)[i].as_py())
                for part in batch.column(3)[i].as_py() or []:
                    if part is not None:
                        v.visit(part)
                texts.append(v.close())
                masks.append([{"start": a, "stop": b} for a, b in v.mask])
                attached.append(v.attachments)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(masks, mask_type),
                 pa.array(attached, attached_type), pa.array([sum(a["tokens"] for a in x) for x in attached], pa.int64())],
                ["conv_id", "turn", "formatted", "mask", "attachments", "attached_tokens"])

    return turns.mapInArrow(run, TURNS)


def read_turn(formatted: str) -> tuple[str, str]:
    """Role and text of one formatted turn; placeholders are no text."""
    role, body = _TURN.fullmatch(formatted).groups()
    return unescape_role(role), unescape(_PLACEHOLDER.sub("", body))


class _Running:
    def __init__(self, conv):
        self.conv, self.turns, self.loss = conv, hashlib.sha256(), hashlib.sha256()
        self.n = self.loss_chars = self.chars = self.attached = 0

    def add(self, formatted: str, mask: list[dict], n_attached: int) -> None:
        role, text = read_turn(formatted)
        self.turns.update(f"{role}\n{text}\n".encode())
        for span in mask:
            part = unescape(formatted[span["start"]:span["stop"]])
            self.loss.update(part.encode())
            self.loss_chars += len(part)
        self.n += 1
        self.chars += len(formatted)
        self.attached += n_attached

    def row(self) -> tuple:
        return (self.conv, self.n, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(),
                self.chars, self.attached)


def digest(turns: DataFrame) -> DataFrame:
    """``DIGEST`` of each conversation, read back from its formatted turns."""
    order = (turns.select("conv_id", "turn", "formatted", "mask", F.size("attachments").alias("n"))
             .repartition("conv_id").sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "formatted"))
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
    names = [c.split()[0] for c in DIGEST.split(", ")]

    def rows(done: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in done], t) for i, t in enumerate(types)], names)

    def run(batches):
        now = None
        for batch in batches:
            done = []
            conv = batch.column(0).to_pylist()
            for i, c in enumerate(conv):
                if now is None or c != now.conv:
                    if now is not None:
                        done.append(now.row())
                    now = _Running(c)
                now.add(batch.column(2)[i].as_py(), batch.column(3)[i].as_py(), batch.column(4)[i].as_py())
            if done:
                yield rows(done)
        if now is not None:
            yield rows([now.row()])

    return order.mapInArrow(run, DIGEST)
