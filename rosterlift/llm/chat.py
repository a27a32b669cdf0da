"""Chat formatting of typed content parts, with attachments, a loss mask and a reversible template.

A turn's content is a list of parts: text, image, audio and document. A visitor goes through them in order; text stays, any
other part leaves a placeholder and an attachment record with the tokens it will expand to. A turn is written as

    ### role: content</turn>

and a line break. In texts a backslash is doubled, and one is put before every ``</turn>``, ``### `` and ``<|``; in roles
before colons too, so whatever a text says, it reads back as it was. A conversation's turns are formatted where range
partitions by conversation and turn put them, into chunks of bounded size: a conversation of any length spreads over
tasks, and reading back streams its chunks in order.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._store import prepare

CHUNK_CHARS = 1 << 18
PARTS = "array<struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>>"
_ATTACHMENT = pa.struct([("turn", pa.int64()), ("at", pa.int64()), ("kind", pa.string()), ("ref", pa.string()), ("tokens", pa.int64())])
_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64())])
_CHUNKS = ("conv_id long, part int, chunk int, formatted string, loss array<struct<start:long,end:long>>, "
           "attachments array<struct<turn:long,at:long,kind:string,ref:string,tokens:long>>")
_CONTROL = re.compile(r"\\|</turn>|### |<\|")
_TURN = re.compile(r"### ((?:[^\\:]|\\.)*): ((?:[^\\<]|\\.|<(?!/turn>))*)</turn>\n", re.DOTALL)
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)


@dataclass(frozen=True)
class Expansion:
    """Tokens that attachments expand to."""

    image_patch: int = 28
    audio_per_second: float = 12.5
    document_per_page: int = 512

    def image(self, part: dict) -> int:
        return math.ceil((part["width"] or 0) / self.image_patch) * math.ceil((part["height"] or 0) / self.image_patch)

    def audio(self, part: dict) -> int:
        return math.ceil((part["seconds"] or 0) * self.audio_per_second)

    def document(self, part: dict) -> int:
        return (part["pages"] or 0) * self.document_per_page


@dataclass
class Flattened:
    """What a visit of a turn's parts gives: its text with placeholders, and the attachments with their places in it."""

    text: str = ""
    attachments: list[dict] = field(default_factory=list)


class Visitor:
    """Goes through parts in order. Unknown kinds leave a placeholder of no tokens; missing parts are passed over."""

    def __init__(self, expansion: Expansion):
        self.expand: dict[str, Callable[[dict], int]] = {
            "image": expansion.image, "audio": expansion.audio, "document": expansion.document}

    def visit(self, parts: list[dict | None]) -> Flattened:
        out = Flattened()
        for part in parts:
            if part is None:
                continue
            kind = part["kind"] or "text"
            if kind == "text":
                out.text += escaped(part["text"] or "")
                continue
            tokens = self.expand.get(kind, lambda _: 0)(part)
            out.attachments.append({"at": len(out.text), "kind": kind, "ref": part["ref"], "tokens": tokens})
            out.text += f"<|{escaped(kind)}:{len(out.attachments)}:{tokens}|>"
        return out


def escaped(text: str) -> str:
    return _CONTROL.sub(lambda m: "\\" + m[0], text)


def unescaped(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def _format(expansion: Expansion, learnt: tuple[str, ...]):
    def run(batches):
        visitor, place = Visitor(expansion), TaskContext.get().partitionId()
        conv, chunk, text, size, loss, attached = None, 0, [], 0, [], []

        def flush():
            return pa.RecordBatch.from_arrays(
                [pa.array([conv], pa.int64()), pa.array([place], pa.int32()), pa.array([chunk], pa.int32()),
                 pa.array(["".join(text)]), pa.array([loss], pa.list_(_SPAN)), pa.array([attached], pa.list_(_ATTACHMENT))],
                ["conv_id", "part", "chunk", "formatted", "loss", "attachments"])
        for batch in batches:
            for c, turn, role, parts in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                if text and (c != conv or size >= CHUNK_CHARS):
                    yield flush()
                    chunk = chunk + 1 if c == conv else 0
                    text, size, loss, attached = [], 0, [], []
                conv = c
                flat = visitor.visit(parts or [])
                head = f"### {escaped(role or '').replace(':', chr(92) + ':')}: "
                begin = size + len(head)
                if role in learnt:
                    loss.append({"start": begin, "end": begin + len(flat.text)})
                attached += [{"turn": turn, **a, "at": begin + a["at"]} for a in flat.attachments]
                text.append(f"{head}{flat.text}</turn>\n")
                size += len(text[-1])
        if text:
            yield flush()
    return run


def formatted(turns: DataFrame, expansion: Expansion = Expansion(), learnt: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """Chunks of formatted conversations: ``conv_id, part, chunk, formatted, loss, attachments``.

    ``turns``: conv_id, turn, role, and ``parts`` (see ``PARTS``) or ``text``, or both: the parts follow the text. Turns are
    ordered by turn, then role and content; repeated rows are turns of their own. Null texts and roles are empty, null
    conversations one conversation, null turns come first. A conversation's chunks follow each other by ``part`` and
    ``chunk``, and no turn is cut. ``loss`` spans and attachments' places are code points of their chunk. Other columns are
    ignored. Store the result before it is used twice.
    """
    prepare(turns.sparkSession)
    parts = F.col("parts").cast(PARTS) if "parts" in turns.columns else F.lit(None).cast(PARTS)
    if "text" in turns.columns:
        text = F.expr("named_struct('kind', 'text', 'text', CAST(text AS STRING), 'ref', CAST(NULL AS STRING), 'width', CAST(NULL AS INT), "
                      "'height', CAST(NULL AS INT), 'seconds', CAST(NULL AS DOUBLE), 'pages', CAST(NULL AS INT))")
        parts = F.concat(F.array(text), F.coalesce(parts, F.array().cast(PARTS)))
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                        F.col("role").cast("string").alias("role"), parts.alias("parts"))
    order = ["conv_id", "turn", "role", "parts"]
    # Many ranges, so that a long conversation takes several of them; rows that are equal in all may share one.
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return rows.mapInArrow(_format(expansion, learnt), _CHUNKS)


def read_turns(text: str) -> Iterator[tuple[str, str]]:
    """Role and content of each turn of a formatted chunk; placeholders stay in the content."""
    at = 0
    while at < len(text):
        m = _TURN.match(text, at)
        if m is None:
            raise ValueError(f"no turn at {at}: {text[at:at + 40]!r}")
        yield unescaped(m[1]), unescaped(m[2])
        at = m.end()


_DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def _digest(batches):
    conv, state, names = None, None, [x.split()[0] for x in _DIGESTS.split(", ")]

    def out():
        turns, all_turns, loss_chars, loss, chars = state
        return pa.RecordBatch.from_arrays(
            [pa.array([conv], pa.int64()), pa.array([turns], pa.int64()), pa.array([all_turns.hexdigest()]),
             pa.array([loss_chars], pa.int64()), pa.array([loss.hexdigest()]), pa.array([chars], pa.int64())], names)
    for batch in batches:
        for c, text, spans in zip(*(x.to_pylist() for x in batch.columns), strict=True):
            if state is not None and c != conv:
                yield out()
                state = None
            conv = c
            turns, all_turns, loss_chars, loss, chars = state or (0, hashlib.sha256(), 0, hashlib.sha256(), 0)
            for role, content in read_turns(text):
                all_turns.update(f"{role}\n{content}\n".encode())
                turns += 1
            for span in spans:
                learnt = unescaped(text[span["start"]:span["end"]])
                loss.update(learnt.encode())
                loss_chars += len(learnt)
            state = (turns, all_turns, loss_chars, loss, chars + len(text))
    if state is not None:
        yield out()


def read_back(chunks: DataFrame) -> DataFrame:
    """Digests of each conversation, from its formatted chunks alone.

    A digest reads its conversation from end to end, so one task does that, but as a stream of chunks; what it holds does
    not grow with the conversation.
    """
    rows = chunks.repartition("conv_id").sortWithinPartitions("conv_id", "part", "chunk").select("conv_id", "formatted", "loss")
    return rows.mapInArrow(_digest, _DIGESTS)
