"""Best-fit packing by minimum bin slack.

Documents become ids, and ids become pieces of at most ``capacity``. How pieces are combined depends on their lengths
alone, so the plan is made from the number of pieces of each length, a table of at most ``capacity`` rows: for one bin
after the other the largest piece left is taken, and a bitset dynamic programme over the lengths left finds the fullest
bin that holds it. That bin is repeated as long as its pieces last, since nothing fuller can come up when pieces only
go, so the plan has a few thousand entries at most, whatever the corpus. Its entries are runs of consecutive numbers of
a length's pieces; pieces are numbered by counts within each partition and prefix sums over the partitions.
"""

from __future__ import annotations

import json
import operator
import re
import zlib
from bisect import bisect_left
from collections.abc import Callable
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._store import Scratch, prepare
from .packing import byte_characters

_LONGEST = 1 << 15  # lengths take 15 bits of a run's key, piece numbers 48
_CACHED_WORDS = 1 << 20
_CACHED_BYTES = 64
_LETTERS = re.compile(rb"(?:[a-z]|\xc3[\xa0-\xb6\xb8-\xbf])+")  # a to z and their Latin-1 kin, composed
_ENDED = re.compile(rb"(.*[A-Za-z0-9])([.,;:!?]+)", re.DOTALL)
_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary, part int, nth long"
_PLACED = "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary, sequence_id long, offset long"


class WordIds(dict):
    """Ids of a tokenizer file whose words never reach over white space: four little-endian bytes each, by word, found when first
    asked for.

    Neither its normal forms nor its pattern look beyond white space, so a text's ids are those of its words in a row, cut at
    ASCII white space; marks behind a letter or digit are words of their own too. Words that came first stay, up to a
    number: frequent ones are among them. ``lower``: the file lower-cases all but special tokens, so words that differ in that have the
    same ids. ``merges`` gives the ids of a word that is small letters only, for which there is nothing to normalise or split.
    """

    def __init__(self, encode: Callable[[str], list[int]], merges: Callable[[bytes], list[int]] | None = None, lower: bool = False):
        super().__init__()
        self.encode, self.merges, self.lower = encode, merges, lower

    def __missing__(self, word: bytes) -> bytes:
        if self.merges and _LETTERS.fullmatch(word):
            ids = np.array(self.merges(word), "<u4").tobytes()
        elif ended := _ENDED.fullmatch(word):
            ids = self[ended[1]] + self[ended[2]]
        else:
            ids = np.array(self.encode(word.decode()), "<u4").tobytes()
        if len(word) <= _CACHED_BYTES and len(self) < _CACHED_WORDS:
            self[word] = ids
        return ids

    def ids(self, text: bytes) -> bytes:
        """The ids of a text."""
        words = (text.lower() if self.lower and b"<|" not in text else text).split()
        return b"".join([self[w] for w in words])


@lru_cache(maxsize=2)
def word_ids(path: str, special_as_text: bool = False) -> WordIds:
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = special_as_text
    file = json.loads(tokenizer.to_str())
    lower = any(n["type"] == "Lowercase" for n in (file["normalizer"] or {}).get("normalizers", []))
    steps = (file["pre_tokenizer"] or {}).get("pretokenizers", [])
    by_bytes = [s["type"] for s in steps] == ["Split", "ByteLevel"] and r"[\p{L}]+" in steps[0]["pattern"].get("Regex", "")
    as_written = {b: c for c, b in byte_characters().items()}
    model = tokenizer.model

    def merges(word: bytes) -> list[int]:
        return [t.id for t in model.tokenize(word.decode("latin-1").translate(as_written))]
    return WordIds(lambda word: tokenizer.encode(word, add_special_tokens=False).ids, merges if by_bytes else None, lower)


def _cut(path: str, end: int, capacity: int, keep_ids: bool, special_as_text: bool):
    def run(batches):
        words, part, last = word_ids(path, special_as_text), TaskContext.get().partitionId(), np.array([end], "<u4").tobytes()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                raw = memoryview(words.ids(text or b"") + last)
                for piece, at in enumerate(range(0, len(raw) // 4, capacity)):
                    ids = raw[4 * at:4 * (at + capacity)]
                    length = len(ids) // 4
                    rows.append((doc, piece, at, length, zlib.crc32(ids), bytes(ids) if keep_ids else None, part, int(seen[length])))
                    seen[length] += 1
            names, kinds = zip(*(x.split() for x in _PIECES.split(", ")), strict=True)
            types = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
            columns = list(zip(*rows, strict=True)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, types[k]) for c, k in zip(columns, kinds, strict=True)], list(names))
    return run


def pieces(docs: DataFrame, path: str, end: int = 1, capacity: int = 4096, keep_ids: bool = True, special_as_text: bool = False,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """First pass: pieces of all documents, and each one's number among its partition's pieces of that length.

    A document is its ids with ``end`` behind them; null and empty texts are ``end`` alone. One of more than ``capacity`` ids is
    cut every ``capacity``. Strings of special tokens in a text are special tokens, as the file's library takes
    them, unless ``special_as_text``. Store the result before it is used twice, so that both uses see the same partitions.
    """
    if not 0 < capacity < _LONGEST:
        raise ValueError(f"capacity {capacity} is not between 1 and {_LONGEST - 1}")
    prepare(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    return texts.mapInArrow(_cut(path, end, capacity, keep_ids, special_as_text), _PIECES)


def fullest(left: dict[int, int], capacity: int) -> dict[int, int]:
    """The largest length of ``left`` (length: how many) and those that fill its bin up as far as possible, each with its number.

    Bit t of ``reach`` says that some of the lengths seen so far add up to t. Lengths come in descending order, in groups of 1, 2,
    4, ... equal ones; the programme ends as soon as the bin is full. Of equally full bins, that of larger pieces is taken.
    """
    lengths = sorted(left, reverse=True)
    bin_, room = {lengths[0]: 1}, capacity - lengths[0]
    reach, mask, steps = 1, (1 << (room + 1)) - 1, []
    for length in lengths[bisect_left(lengths, -room, key=operator.neg):]:
        if reach >> room & 1:
            break
        many = min(left[length] - bin_.get(length, 0), room // length)
        group = 1
        while many > 0 and not reach >> room & 1:
            group = min(group, many)
            before, reach = reach, (reach | reach << group * length) & mask
            if reach != before:
                steps.append((length, group, before))
            many, group = many - group, group * 2
    total = reach.bit_length() - 1
    for length, group, before in reversed(steps):
        if not before >> total & 1:
            bin_[length] = bin_.get(length, 0) + group
            total -= group * length
    return bin_


@dataclass(frozen=True)
class Plan:
    """Where each piece lies: run i holds, from its first piece on, ``per_bin`` pieces of its length a sequence."""

    key: np.ndarray  # length and number of the run's first piece
    per_bin: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    sequences: int

    def place(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = (length << 48) + number
        run = np.searchsorted(self.key, key, "right") - 1
        sequence, copy = np.divmod(key - self.key[run], self.per_bin[run])
        return self.sequence[run] + sequence, self.offset[run] + copy * length


def plan(counts: dict[int, int], capacity: int) -> Plan:
    """Bins for ``counts[length]`` pieces of each length, the fullest possible one by one."""
    left, used, runs, sequences = {n: c for n, c in counts.items() if c > 0}, dict.fromkeys(counts, 0), [], 0
    while left:
        bin_ = fullest(left, capacity)
        times, offset = min(left[n] // k for n, k in bin_.items()), 0
        for n in sorted(bin_, reverse=True):
            k = bin_[n]
            runs.append(((n << 48) + used[n], k, sequences, offset))
            used[n] += k * times
            offset += k * n
            left[n] -= k * times
            if not left[n]:
                del left[n]
        sequences += times
    table = np.array(sorted(runs), np.int64).reshape(-1, 4)
    return Plan(*table.T, sequences)


def _place(plan_: Plan):
    def run(batches):
        names = [x.split()[0] for x in _PLACED.split(", ")]
        for batch in batches:
            at = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            sequence, offset = plan_.place(at["length"].to_numpy(), at["number"].to_numpy())
            yield pa.RecordBatch.from_arrays([*(at[n] for n in names[:-2]), pa.array(sequence), pa.array(offset)], names)
    return run


def pack(stored: DataFrame, capacity: int = 4096) -> DataFrame:
    """Second pass, over stored rows of ``pieces``: each piece with its sequence and its place there, gapless from 0.

    Only the number of pieces of each length comes to the driver, and the plan, at most some hundred thousand numbers for a
    capacity of 4,096, goes out with the tasks.
    """
    counts = stored.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    totals = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    numbered = stored.join(base, ["part", "length"]).withColumn("number", F.col("base") + F.col("nth"))
    columns = [x.split()[0] for x in _PLACED.split(", ")][:-2]
    return numbered.select(*columns, "number").mapInArrow(_place(plan(totals, capacity)), _PLACED)


def packed_fullest(docs: DataFrame, path: str, end: int = 1, capacity: int = 4096, keep_ids: bool = True,
                   special_as_text: bool = False, id_col: str = "doc_id", text_col: str = "text",
                   scratch: Scratch | None = None) -> DataFrame:
    """Whole documents in as few sequences of at most ``capacity`` ids as minimum bin slack finds, one row per piece.

    ``doc_id, piece, start, length, ids_crc32, ids, sequence_id, offset``: the piece is the document's ids from ``start`` on (``ids``,
    four little-endian bytes each, null without ``keep_ids``). Rows that repeat an id or have none are documents of
    their own; an empty table gives no rows; other columns are ignored.
    """
    scratch = scratch or Scratch(docs.sparkSession)
    cut = pieces(docs, path, end, capacity, keep_ids, special_as_text, id_col, text_col)
    return pack(scratch.keep(cut, "pieces"), capacity)
