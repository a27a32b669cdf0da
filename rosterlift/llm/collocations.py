"""Phrase collocations by a multikey three-way quicksort of suffix pointers.

Every word begins a suffix of its piece, of which the first ``depth`` = 3 words matter. Tasks that read texts sort the
suffixes of some megabytes at a time, so that equal ones become one with a weight, and route them by their first two
words; a phrase's suffixes then lie in one group, wherever in the corpus it stands. Within a group, pointers to suffixes are
sorted by one word after the other with three-way partitions: the weight of an equal partition is the phrase's count,
equal partitions go on with the next word, and partitions of less weight than a phrase needs are abandoned. Groups are
sized by the text's bytes. Leading words so common that one group of theirs would outgrow the others, as a sample shows,
are routed by their third word too, and their counts added up afterwards.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._store import Scratch, prepare
from ._text import U, chunks, lower, mix, span_hashes

_CHUNK_BYTES = 1 << 20
_SLICE = 1 << 20  # suffixes sorted at a time; their numbers have to fit in 21 bits
_BLOB = 1 << 18  # suffixes of one routed row
_SEED = np.uint64(0x2545F4914F6CDD1D)

_BREAK = np.zeros(256, bool)
_BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_GAP = _BREAK.copy()
_GAP[[0x20, 0x09]] = True


@dataclass(frozen=True)
class Collocations:
    """What is a candidate, what is kept of it, and how large a group is; the last three change no result."""

    least: int = 10  # occurrences of a candidate
    inside: int = 50  # a candidate goes if a longer one around it has this many per cent of its occurrences
    first: int = 2000  # phrases reported of each language
    group_bytes: int = 6 << 20  # text whose suffixes make up a group
    sample_rows: int = 4000  # texts looked at for common leading words
    common: float = 1 / 512  # the share of suffixes that makes leading words common


@dataclass
class _Words:
    """The words of some texts in a row; ``goes_on``: the word before is in the same piece."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    lang: np.ndarray
    hash: np.ndarray
    goes_on: np.ndarray


class _Reader:
    """Words of Arrow batches (lang, text), in slices of bounded size; languages get numbers as they come."""

    def __init__(self) -> None:
        self.langs: dict[str, int] = {}
        self.seeds = np.zeros(0, np.uint64)

    def _numbers(self, langs: pa.Array) -> np.ndarray:
        codes = langs.dictionary_encode()
        for name in codes.dictionary.to_pylist():
            if name not in self.langs:
                self.langs[name] = len(self.langs)
                raw = np.frombuffer(name.encode(), np.uint8)
                self.seeds = np.append(self.seeds, span_hashes(raw, np.array([0]), np.array([len(raw)])) * _SEED)
        to = np.array([self.langs[name] for name in codes.dictionary.to_pylist()], np.int64)
        return to[codes.indices.to_numpy()]

    def pieces(self, batch: pa.RecordBatch) -> Iterator[_Words]:
        of_text = self._numbers(batch.column(0))
        for texts in chunks(batch.column(1), _CHUNK_BYTES):
            data = lower(texts.data)
            edge = np.zeros(len(data) + 1, bool)
            edge[texts.offsets] = True
            inside = ~_GAP[data]
            start, end = inside.copy(), inside.copy()
            start[1:] &= ~inside[:-1] | edge[1:len(data)]
            end[:-1] &= ~inside[1:] | edge[1:len(data)]
            start, end = np.flatnonzero(start), np.flatnonzero(end) + 1
            if not len(start):
                continue
            text = np.searchsorted(texts.offsets, start, "right") - 1
            breaks = np.concatenate([[0], np.cumsum(_BREAK[data])])[start]
            goes_on = np.zeros(len(start), bool)
            goes_on[1:] = (text[1:] == text[:-1]) & (breaks[1:] == breaks[:-1])
            lang = of_text[texts.first + text]
            h = mix(span_hashes(data, start, end) ^ self.seeds[lang]) | U(1)  # 0 stands for no word
            yield _Words(data, start, end, lang, h, goes_on)

    def slices(self, batches) -> Iterator[tuple[_Words, int]]:
        """Some words at a time, and how many of them begin a suffix of this slice; the last ones may only follow."""
        held, n = [], 0
        for batch in batches:
            for piece in self.pieces(batch):
                held.append(piece)
                n += len(piece.hash)
                if n >= _SLICE:
                    yield from self._cut(held)
                    held, n = [], 0
        if held:
            yield from self._cut(held)

    @staticmethod
    def _cut(held: list[_Words]) -> Iterator[tuple[_Words, int]]:
        shift = np.cumsum([0] + [len(w.data) for w in held])
        data, lang, h, goes_on = (np.concatenate([getattr(w, name) for w in held]) for name in ("data", "lang", "hash", "goes_on"))
        start, end = (np.concatenate([getattr(w, name) + s for w, s in zip(held, shift, strict=False)]) for name in ("start", "end"))
        held.clear()
        for a in range(0, len(h), _SLICE):
            b = slice(a, a + _SLICE + 2)
            yield _Words(data, start[b], end[b], lang[b], h[b], goes_on[b]), min(_SLICE, len(h) - a)


def _numbered(h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct hashes in order, a place of each, and every hash's number among them, from 1."""
    order = np.argsort(h)
    begin = _runs(h[order])
    number = np.empty(len(h), np.int64)
    number[order] = np.repeat(np.arange(1, len(begin) + 1), np.diff(np.append(begin, len(h))))
    return h[order[begin]], order[begin], number


def _following(key: np.ndarray, goes_on: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The second and third word of each suffix, 0 where its piece has no more."""
    second, third = np.zeros_like(key), np.zeros_like(key)
    second[:-1] = np.where(goes_on[1:], key[1:], 0)
    third[:-1] = np.where(goes_on[1:], second[1:], 0)
    return second, third


def route(first: np.ndarray, second: np.ndarray, third: np.ndarray, groups: int, common: np.ndarray) -> np.ndarray:
    """The group of each suffix: by its first two words, and by the third if those are common ones."""
    pair = mix(first * U(3) + second)
    if len(common):
        at = np.minimum(np.searchsorted(common, pair), len(common) - 1)
        pair = np.where(common[at] == pair, mix(pair + third), pair)
    return (pair % U(groups)).astype(np.int64)


def _runs(*keys: np.ndarray) -> np.ndarray:
    """Where a run of equal keys begins."""
    new = np.zeros(len(keys[0]), bool)
    if len(new):
        new[0] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


def packed_suffixes(first: np.ndarray, second: np.ndarray, third: np.ndarray, weight: np.ndarray) -> bytes:
    """Sorted suffixes without repeating equal leading words."""
    one, two = _runs(first), _runs(first, second)
    head = np.array([len(one), len(two), len(first)], "<u4")
    per_one = np.diff(np.searchsorted(two, np.append(one, len(first)))).astype("<u4")
    per_two = np.diff(np.append(two, len(first))).astype("<u4")
    return b"".join(x.tobytes() for x in (head, first[one], per_one, second[two], per_two, third, weight.astype("<u4")))


def unpacked_suffixes(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    n1, n2, n3 = (int(x) for x in np.frombuffer(blob, "<u4", 3))
    at, out = 12, []
    for n, kind in ((n1, "<u8"), (n1, "<u4"), (n2, "<u8"), (n2, "<u4"), (n3, "<u8"), (n3, "<u4")):
        out.append(np.frombuffer(blob, kind, n, at))
        at += out[-1].nbytes
    first, per_one, second, per_two, third, weight = out
    return np.repeat(np.repeat(first, per_one), per_two), np.repeat(second, per_two), third, weight.astype(np.int64)


_WORDS = "lang string, word binary, hash long, n long"
_ROUTED = "route long, suffixes binary"


def _vocabulary(batches):
    """A row for each word of a slice, with its count."""
    reader = _Reader()
    for words, n in reader.slices(batches):
        found, at, number = _numbered(words.hash[:n])
        start, size = words.start[at], words.end[at] - words.start[at]
        names = pa.array(list(reader.langs))
        for a in range(0, len(found), 20_000):
            b = slice(a, a + 20_000)
            offsets = np.concatenate([[0], np.cumsum(size[b])])
            spelt = words.data[np.repeat(start[b] - offsets[:-1], size[b]) + np.arange(offsets[-1])]
            spelt = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(spelt)])
            lang = pa.DictionaryArray.from_arrays(pa.array(words.lang[at[b]]), names).cast(pa.string())
            counts = np.bincount(number, minlength=len(found) + 1)[1:][b]
            yield pa.RecordBatch.from_arrays([lang, spelt.cast(pa.binary()), pa.array(found[b].view(np.int64)), pa.array(counts)],
                                             ["lang", "word", "hash", "n"])


def _emit(groups: int, common: np.ndarray):
    """Routed suffixes of two and more words, equal ones of a slice once; single words are counted with the vocabulary."""
    def run(batches):
        for words, n in _Reader().slices(batches):
            found, _, number = _numbered(words.hash)
            second, third = _following(number, words.goes_on)
            key = (number << 42 | second << 21 | third)[:n][second[:n] > 0]
            key, weight = np.unique(key, return_counts=True)
            found = np.concatenate([[U(0)], found])
            suffix = [found[key >> 42], found[key >> 21 & 0x1FFFFF], found[key & 0x1FFFFF]]
            to = route(*suffix, groups, common)
            order = np.argsort(to, kind="stable")
            to, weight, suffix = to[order], weight[order], [x[order] for x in suffix]
            begin = _runs(to)
            cuts = [(c, min(c + _BLOB, b)) for a, b in zip(begin, np.append(begin[1:], len(to)), strict=True) for c in range(a, b, _BLOB)]
            for k in range(0, len(cuts), 256):
                blobs = [packed_suffixes(*(x[c:d] for x in suffix), weight[c:d]) for c, d in cuts[k:k + 256]]
                yield pa.RecordBatch.from_arrays([pa.array([int(to[c]) for c, _ in cuts[k:k + 256]], pa.int64()), pa.array(blobs, pa.binary())],
                                                 ["route", "suffixes"])
    return run


def _leading(batches):
    """Leading words that make up a notable share of some texts of a sample."""
    reader = _Reader()
    for batch in batches:
        for words in reader.pieces(batch):
            second, _ = _following(words.hash, words.goes_on)
            pair, n = np.unique(mix(words.hash * U(3) + second)[second != 0], return_counts=True)
            often = n * 4096 >= len(words.hash)
            yield pa.RecordBatch.from_arrays([pa.array(pair[often].view(np.int64)), pa.array(n[often])], ["pair", "n"])
            yield pa.RecordBatch.from_arrays([pa.array([0], pa.int64()), pa.array([len(words.hash)], pa.int64())], ["pair", "n"])


def multikey_quicksort(keys: list[np.ndarray], weight: np.ndarray, least: int, always: np.ndarray | None = None):
    """Phrases of two and more words, from the suffixes' words (0: no word) and weights.

    Yields (depth, pointers, counts): suffixes that begin with each phrase of ``depth`` words that occurs ``least`` times or more, and
    how often. All partitions of one round are split at once, each around its own pivot, the key of a suffix drawn from it. Less,
    equal and greater pointers keep their order; what is equal goes on with the next word. ``always`` marks suffixes whose phrases
    of two words are reported however rare, since other groups have more of them.
    """
    pointers = np.arange(len(weight))
    begin, depth, turn = np.zeros(min(1, len(weight)), np.int64), np.zeros(min(1, len(weight)), np.int64), 0
    stacked = np.stack(keys) if len(weight) else np.zeros((len(keys), 0), np.uint64)
    keep_pairs = np.zeros(len(weight), bool) if always is None else always
    while len(pointers):
        turn += 1
        size = np.diff(np.append(begin, len(pointers)))
        key = stacked[np.repeat(depth, size), pointers]
        draw = begin + (mix(begin.astype(np.uint64) + U(turn)) % size.astype(np.uint64)).astype(np.int64)
        pivot = np.repeat(key[draw], size)
        side = np.where(key < pivot, 0, np.where(key == pivot, 1, 2))
        # A stable three-way split: a pointer's new place is its rank among its partition's pointers of its side.
        place = np.empty(len(pointers), np.int64)
        total, counts = np.zeros(len(begin), np.int64), np.empty((len(begin), 3), np.int64)
        for s in range(3):
            here = side == s
            upto = np.cumsum(here)
            counts[:, s] = np.add.reduceat(here, begin)
            rank = upto - np.repeat(upto[begin] - here[begin], size) - 1
            place[here] = (np.repeat(begin + total, size) + rank)[here]
            total += counts[:, s]
        moved = np.empty_like(pointers)
        moved[place] = pointers
        edges = np.concatenate([[0], np.cumsum(counts.ravel())])
        parts = np.flatnonzero(counts.ravel())
        first, size = edges[parts], counts.ravel()[parts]
        heavy = np.add.reduceat(weight[moved], first)
        of, equal = parts // 3, parts % 3 == 1
        reached = depth[of] + equal
        ended = equal & (pivot[begin][of] == 0)  # the pieces end here
        rare = heavy < least
        kept = np.logical_or.reduceat(keep_pairs[moved], first)
        for d in range(2, len(keys) + 1):
            found = equal & ~ended & (reached == d) & (~rare | (kept & (d == 2)))
            if found.any():
                yield d, moved[first[found]], heavy[found]
        going = ~ended & (reached < len(keys)) & (~rare | (kept & (reached < 2)))
        alive = np.repeat(going, size)
        pointers, depth = moved[alive], reached[going]
        begin = np.concatenate([[0], np.cumsum(size[going])])[:-1].astype(np.int64)


_PHRASES = "first long, second long, third long, n long"
_PHRASES_ARROW = pa.schema([(x.split()[0], pa.int64()) for x in _PHRASES.split(", ")])


def _count(least: int, common: np.ndarray):
    def run(table: pa.Table) -> pa.Table:
        unpacked = [unpacked_suffixes(b) for b in table.column("suffixes").to_pylist()]
        first, second, third, weight = (np.concatenate(x) for x in zip(*unpacked, strict=True))
        spread = np.isin(mix(first * U(3) + second), common)
        out = []
        for depth, at, counts in multikey_quicksort([first, second, third], weight, least, spread):
            out.append((first[at], second[at], third[at] if depth == 3 else np.zeros(len(at), np.uint64), counts))
        columns = [np.concatenate(x) for x in zip(*out, strict=True)] if out else [np.zeros(0, np.int64)] * 4
        return pa.Table.from_arrays([pa.array(c.view(np.int64)) for c in columns], schema=_PHRASES_ARROW)
    return run


def _common_pairs(texts: DataFrame, options: Collocations) -> np.ndarray:
    """Hashes of the leading words that are common in a sample: sorted, and fewer than 2 / ``common``.

    They only decide where suffixes are counted, never whether; the same ones hold for all tasks.
    """
    rows = texts.count()
    sample = texts.sample(min(1.0, options.sample_rows / max(rows, 1)), 7)
    seen = sample.mapInArrow(_leading, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    seen = seen.orderBy(F.col("n").desc()).limit(int(2 / options.common)).collect()
    total = next((r["n"] for r in seen if r["pair"] == 0), 0)
    often = [r["pair"] for r in seen if r["pair"] != 0 and r["n"] >= options.common * total]
    return np.sort(np.array(often, np.int64).view(np.uint64))


def phrases(docs: DataFrame, options: Collocations = Collocations(), text_col: str = "text", lang_col: str = "lang",
            scratch: Scratch | None = None) -> tuple[DataFrame, DataFrame]:
    """All words (``lang, word, hash, n``) and all phrases of two and three words that occur ``least`` times or more
    (``first, second, third, n``: the words' hashes, which tell languages apart; third is null for two words)."""
    spark = docs.sparkSession
    scratch = scratch or Scratch(spark)
    prepare(spark)
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    size = texts.agg(F.sum(F.octet_length("text").cast("long")).alias("size")).first()["size"] or 0
    groups = size // options.group_bytes + 1
    common = _common_pairs(texts, options) if groups > 1 else np.zeros(0, np.uint64)
    words = texts.mapInArrow(_vocabulary, _WORDS).groupBy("lang", "word").agg(F.first("hash").alias("hash"), F.sum("n").alias("n"))
    words = scratch.keep(words.select("lang", F.col("word").cast("string").alias("word"), "hash", "n"), "words")
    scratch.release()
    # Texts are read twice, so that the suffixes, which take more room than they, lie in one exchange and nowhere else.
    routed = texts.mapInArrow(_emit(groups, common), _ROUTED)
    counted = routed.groupBy("route").applyInArrow(_count(options.least, common), _PHRASES)
    found = counted.groupBy("first", "second", "third").agg(F.sum("n").alias("n")).where(F.col("n") >= options.least)
    third = F.when(F.col("third") != 0, F.col("third")).alias("third")
    found = scratch.keep(found.select("first", "second", third, "n"), "phrases")
    scratch.release()
    return words, found


def _score(a: str, left: str, right: str) -> F.Column:
    """floor(1000000 * a * a / (l * r)) in whole numbers of up to 38 digits."""
    wide = f"(CAST(1000000 AS DECIMAL(38,0)) * CAST({a} AS DECIMAL(15,0)) * CAST({a} AS DECIMAL(15,0)))"
    return F.expr(f"CAST({wide} div (CAST({left} AS DECIMAL(15,0)) * CAST({right} AS DECIMAL(15,0))) AS LONG)")


def collocations(docs: DataFrame, options: Collocations = Collocations(), text_col: str = "text", lang_col: str = "lang",
                 scratch: Scratch | None = None) -> DataFrame:
    """The best phrases of each language: ``lang, rank, phrase, a, l, r, n, score``.

    Texts are lower-cased (A-Z), cut into pieces at marks and line ends and into words at spaces and tabs. A phrase of two or three
    words with ``a`` >= ``least`` occurrences scores floor(1000000 a a / (l r)) for its weakest cut (the first of equally weak
    ones) into parts with l and r occurrences. It goes if a longer candidate around it has ``inside`` per cent of its occurrences. ``n`` is the
    number of the language's words. Ties rank by a, then by the phrase's bytes. Null texts are empty, a null language is
    ``und``, an empty table gives no rows, repeated rows count as often as they stand there, other columns are ignored.
    """
    words, found = phrases(docs, options, text_col, lang_col, scratch)
    total = words.groupBy("lang").agg(F.sum("n").alias("total"))
    known = words.where(F.col("n") >= options.least)
    two = found.where("third IS NULL").select("first", "second", F.col("n").alias("a"))
    three = found.where("third IS NOT NULL").withColumnRenamed("n", "a")

    around = three.select("first", "second", "a").union(three.select(F.col("second"), F.col("third"), "a"))
    around = around.groupBy("first", "second").agg(F.max("a").alias("longer"))
    two = two.join(around, ["first", "second"], "left")
    part = found.where("third IS NULL")
    three = three.join(part.select("first", "second", F.col("n").alias("head")), ["first", "second"])
    three = three.join(part.select(F.col("first").alias("second"), F.col("second").alias("third"), F.col("n").alias("tail")), ["second", "third"])
    kept = two.where(F.coalesce(100 * F.col("longer") < options.inside * F.col("a"), F.lit(True)))
    null = F.lit(None).cast("long")
    both = kept.select("first", "second", null.alias("third"), "a", null.alias("head"), null.alias("tail")).union(
        three.select("first", "second", "third", "a", "head", "tail"))
    for place in ("first", "second", "third"):
        named = known.select(F.col("hash").alias(place), F.col("word").alias(f"{place}_word"), F.col("n").alias(f"{place}_n"),
                             *([F.col("lang")] if place == "first" else []))
        both = both.join(named, place, "left" if place == "third" else "inner")
    cut = both.withColumn("early", _score("a", "first_n", "coalesce(tail, second_n)")).withColumn(
        "late", F.when(F.col("third").isNotNull(), _score("a", "head", "third_n")))
    is_late = F.coalesce(F.col("late") < F.col("early"), F.lit(False))
    scored = cut.select(
        "lang", F.concat_ws(" ", "first_word", "second_word", "third_word").alias("phrase"), "a",
        F.when(is_late, F.col("head")).otherwise(F.col("first_n")).alias("l"),
        F.when(is_late, F.col("third_n")).otherwise(F.coalesce("tail", "second_n")).alias("r"),
        F.when(is_late, F.col("late")).otherwise(F.col("early")).alias("score"))
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    # The best of each slice of a language, then the best of all: no language has to be sorted in one task.
    sliced = scored.withColumn("slice", F.pmod(F.xxhash64("phrase"), F.lit(64)))
    sliced = sliced.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "slice").orderBy(*order))).where(F.col("rank") <= options.first)
    ranked = sliced.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= options.first)
    return ranked.join(total, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", F.col("total").alias("n"), "score")
