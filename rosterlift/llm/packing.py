"""Packing by concatenating and cutting.

All documents' ids form one long sequence, cut every ``window`` ids. The first pass encodes each partition, stores the
ids and where each document begins within its partition. Prefix sums over the partitions' totals give every document
its place in the whole; the second pass cuts it there. Only the last window is not full. Neither the ids nor the
documents are ever shuffled, and no task holds more than a batch of them.
"""

from __future__ import annotations

import json
import zlib
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._store import Scratch, prepare

_BLOCK = 4096  # partitions whose totals are summed in one window
_TOKENS = "doc_id long, part int, begin long, n_ids long, ids binary"
_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def byte_characters() -> dict[str, int]:
    """The characters by which byte-level vocabularies write bytes: printable ones stand for themselves."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


@lru_cache(maxsize=2)
def _encoder(path: str, pattern: str, special_as_text: bool = False):
    """The merges of a byte-level tokenizer file, run by tiktoken: its ids rise in the order of the merges, and
    it needs a fifth of the time that the file's own library takes. As there, the strings of special tokens in a text are
    these tokens, unless ``special_as_text``."""
    import tiktoken
    byte = byte_characters()
    model = json.loads(Path(path).read_text(encoding="utf-8"))
    special = {t["content"]: t["id"] for t in model["added_tokens"] if t["special"]}
    ranks = {bytes(byte[c] for c in token): i for token, i in model["model"]["vocab"].items() if token not in special}
    encoding = tiktoken.Encoding(path, pat_str=pattern, mergeable_ranks=ranks, special_tokens={} if special_as_text else special)
    if special_as_text:
        return encoding.encode_ordinary
    return lambda text: encoding.encode(text, allowed_special="all") if any(s in text for s in special) else encoding.encode_ordinary(text)


def _encode(path: str, pattern: str, end: int, special_as_text: bool):
    def run(batches):
        encode, part, begin = _encoder(path, pattern, special_as_text), TaskContext.get().partitionId(), 0
        for batch in batches:
            ids = [np.array([*encode(t or ""), end], "<u4") for t in batch.column(1).to_pylist()]
            sizes = np.array([len(x) for x in ids], np.int64)
            begins = begin + np.cumsum(sizes) - sizes
            begin += int(sizes.sum())
            narrow = [x.astype("<u2").tobytes() if x.max() < 1 << 16 else x.tobytes() for x in ids]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.full(len(ids), part, np.int32)), pa.array(begins), pa.array(sizes),
                 pa.array(narrow, pa.binary())], ["doc_id", "part", "begin", "n_ids", "ids"])
    return run


def encoded(docs: DataFrame, path: str, pattern: str, end: int = 0, id_col: str = "doc_id", text_col: str = "text",
            special_as_text: bool = False) -> DataFrame:
    """First pass: each document's ids with ``end`` behind them, packed as 2 or 4 bytes each, and its place in its partition.

    Strings of special tokens in a text are special tokens, as the file's library takes them, unless ``special_as_text``.

    Store the result before it is used twice, so that both uses see the same partitions.
    """
    prepare(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return texts.mapInArrow(_encode(path, pattern, end, special_as_text), _TOKENS)


def _cut(window: int):
    def run(batches):
        for batch in batches:
            out: list[list[int | None]] = [[] for _ in range(7)]
            for doc, start, n, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                raw = memoryview(ids if len(ids) == 4 * n else np.frombuffer(ids, "<u2").astype("<u4").tobytes())
                at = 0
                while at < n:
                    sequence, offset = divmod(start + at, window)
                    size = min(n - at, window - offset)
                    for column, value in zip(out, (doc, at, size, zlib.crc32(raw[4 * at:4 * (at + size)]), n, sequence, offset),
                                             strict=True):
                        column.append(value)
                    at += size
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], [x.split()[0] for x in _PIECES.split(", ")])
    return run


def pack(tokens: DataFrame, window: int = 1024) -> DataFrame:
    """Second pass, over stored rows of ``encoded``: one row per piece of a document in a window.

    ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``: the piece is the document's ids from ``start``
    on, and lies at ``offset`` of its sequence. Offsets are gapless from 0; every sequence but the last holds exactly
    ``window`` ids. Rows that repeat an id or have none are documents of their own.
    """
    totals = tokens.groupBy("part").agg(F.sum("n_ids").alias("total")).withColumn("block", F.expr(f"part div {_BLOCK}"))
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    blocks = totals.groupBy("block").agg(F.sum("total").alias("total"))
    blocks = blocks.select("block", F.coalesce(F.sum("total").over(before.orderBy("block")), F.lit(0)).alias("far"))
    near = F.coalesce(F.sum("total").over(before.partitionBy("block").orderBy("part")), F.lit(0))
    base = totals.withColumn("near", near).join(blocks, "block").select("part", (F.col("near") + F.col("far")).alias("base"))
    # One row of 12 bytes for each partition of the first pass: a few megabytes for a million of them.
    placed = tokens.join(F.broadcast(base), "part").select("doc_id", F.col("begin") + F.col("base"), "n_ids", "ids")
    return placed.mapInArrow(_cut(window), _PIECES)


def packed(docs: DataFrame, path: str, pattern: str, window: int = 1024, end: int = 0, id_col: str = "doc_id",
           text_col: str = "text", scratch: Scratch | None = None, special_as_text: bool = False) -> DataFrame:
    """Encode, store and cut whole texts; null texts count as empty, and an empty text is its end id alone."""
    scratch = scratch or Scratch(docs.sparkSession)
    return pack(scratch.keep(encoded(docs, path, pattern, end, id_col, text_col, special_as_text), "tokens"), window)
