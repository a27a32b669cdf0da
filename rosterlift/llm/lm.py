"""Language-model scores by prediction by partial matching over bytes.

The training texts fill a trie of byte contexts: the empty one, the last byte, up to the last ``order`` bytes, each with
the counts of the bytes that followed it. A byte is predicted from its longest known context. If that has not seen
it, an escape is paid (one count for each byte value seen there, and the counts pruned from it), and the next shorter
context predicts it, without the values the longer one has already ruled out. The empty context escapes to a uniform
choice among the byte values it has not seen. The log-probabilities of all bytes and of an end mark add up to the text's.

Counting is a Spark aggregation over all training bytes, and the trie is a stored table that keeps all that was counted,
unless ``share`` says otherwise. Since the values ruled out are exactly those of the longer context, all escapes and
denominators are numbers of a context, computed once. The longest entries that make up at least ``frequent`` of all
training positions go to the tasks, at most 1 / frequent of them at any size of the corpus: a hash table gives their
log-probabilities for whole batches of positions. The other positions are counted by their last bytes for each text.
The distinct ones are looked up in the trie, depth by depth from the empty context on, and joined back.

The base score, a smoothed unigram model of words, needs every word's count. Words that make up at least ``word_share`` of
all tokens (so at most 1 / word_share of them) are scored on the spot; the rarer ones are joined.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._store import Scratch
from ._text import U, Texts, chunks, lower, mix, span_hashes, words

END = 0xFF  # never a byte of UTF-8: ends a text, and stands for what precedes it
_HELD = 1 << 20  # distinct keys that a task counts before it hands them on
_PIECE = 1 << 18  # bytes of text worked on at once: each takes some hundred bytes of memory


@dataclass(frozen=True)
class PartialMatching:
    order: int = 5  # longest context, in bytes; at most 6
    share: float = 0.0  # of all positions: entries that make up less are pruned
    frequent: float = 2.0**-22  # of all positions: entries that make up as much are scored on the spot
    word_share: float = 2.0**-22


def _laid_out(part: Texts, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each text's bytes behind ``order`` marks and before one; the predicted positions; where each text's begin."""
    sizes = np.diff(part.offsets) + 1
    first = np.concatenate([[0], np.cumsum(sizes)])
    gaps = np.repeat((np.arange(len(part)) + 1) * order, sizes)
    at = np.arange(first[-1]) + gaps
    line = np.full(first[-1] + len(part) * order, END, np.uint8)
    own = np.ones(first[-1], bool)
    own[first[1:] - 1] = False  # the end mark
    line[at[own]] = lower(part.data)
    return line, at, first


def _keys(line: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """The ``size`` bytes that end at each position, as one number."""
    key = np.zeros(len(at), np.uint64)
    for k in range(size - 1, -1, -1):
        key = (key << U(8)) | line[at - k].astype(np.uint64)
    return key


class _Tally:
    """Counts of keys, summed as they come in."""

    def __init__(self) -> None:
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, keys: np.ndarray) -> None:
        found = np.unique(keys, return_counts=True)
        self.parts.append(found)
        self.size += len(found[0])
        if self.size > _HELD:
            self.merge()

    def merge(self) -> None:
        if len(self.parts) > 1:
            keys, n = (np.concatenate(x) for x in zip(*self.parts, strict=True))
            keys, which = np.unique(keys, return_inverse=True)
            self.parts = [(keys, np.bincount(which, n, len(keys)).astype(np.int64))]
        self.size = sum(len(k) for k, _ in self.parts)

    def out(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        self.merge()
        for keys, n in self.parts:
            for i in range(0, len(keys), 100_000):
                yield keys[i:i + 100_000].view(np.int64), n[i:i + 100_000].astype(np.int64)
        self.parts, self.size = [], 0


def _count(order: int):
    """Counts of n-grams of bytes (kind 0) and of words (kind 1) of each partition."""
    def run(batches):
        grams, terms = _Tally(), _Tally()

        def rows(kind, tally):
            for keys, n in tally.out():
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), kind, np.int32)), pa.array(keys), pa.array(n)],
                                                 ["kind", "key", "n"])
        for batch in batches:
            for part in chunks(batch.column(0), _PIECE):
                line, at, _ = _laid_out(part, order)
                grams.add(_keys(line, at, order + 1))
                data = lower(part.data)
                w = words(data, part.offsets)
                terms.add(span_hashes(data, w.start, w.end))
                for kind, tally in enumerate((grams, terms)):
                    if tally.size > _HELD:  # even merged
                        yield from rows(kind, tally)
        for kind, tally in enumerate((grams, terms)):
            yield from rows(kind, tally)
    return run


class Table:
    """A hash table of 64-bit keys with linear probing, looked up for many keys at once; gives positions, or -1.

    A slot holds the position of its key in ``keys``, 4 bytes: at 4 million keys, the most that a task is given, the slots take
    64 MB and the keys are not copied. A task builds its tables and lets them go, so idle workers hold none.
    """

    def __init__(self, keys: np.ndarray):
        bits = max(4, int(np.ceil(np.log2(max(1, len(keys)) * 2.5))))
        self.shift, self.mask, self.keys = U(64 - bits), (1 << bits) - 1, keys
        self.slots = np.full(1 << bits, -1, np.int32)
        todo, at = np.arange(len(keys), dtype=np.int32), self._home(keys)
        while len(todo):
            free = self.slots[at] < 0
            self.slots[at[free]] = todo[free]  # of several keys one stays
            left = self.slots[at] != todo
            # A key that lost a free slot tries on from there.
            todo, at = todo[left], (at[left] + 1) & self.mask

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return (mix(keys) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        at = self._home(keys)
        found = self.slots[at]
        off = np.flatnonzero(found >= 0)
        off = off[self.keys[found[off]] != keys[off]]
        while len(off):
            at[off] = (at[off] + 1) & self.mask
            found[off] = self.slots[at[off]]
            off = off[found[off] >= 0]
            off = off[self.keys[found[off]] != keys[off]]
        return found


def _counted(rows: np.ndarray, keys: np.ndarray, n: int) -> pa.ListArray:
    """The distinct keys of each of ``n`` rows with how often they occur."""
    order = np.lexsort((keys, rows))
    keys, rows = keys[order], rows[order]
    edge = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]) | (rows[1:] != rows[:-1])])[:len(keys)])
    times = np.diff(np.append(edge, len(keys)))
    ends = np.searchsorted(rows[edge], np.arange(n + 1))
    pairs = pa.StructArray.from_arrays([pa.array(keys[edge].view(np.int64)), pa.array(times.astype(np.int64))], names=["key", "times"])
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pairs)


def _scores(frequent, heavy, total: int, vocabulary: int, order: int):
    """Per row: tokens, scores by the model and base scores of what is known here, and the other positions and words with their counts."""
    def run(batches):
        (grams, logs), (terms, term_counts) = frequent.value, heavy.value
        entries, known = Table(grams), Table(terms)
        unit = np.log10(total + 0.1 * (vocabulary + 1))
        gain = np.log10(term_counts + 0.1) - unit

        def held(table, values, row, keys, n):
            """The sum, for each row, of the values of the keys that the table has; their number; and the other keys."""
            which = table.find(keys)
            here = which >= 0
            sums = np.bincount(row[here], values[which[here]], n) if here.any() else np.zeros(n)
            return sums, np.bincount(row[here], minlength=n), _counted(row[~here], keys[~here], n)
        for batch in batches:
            for part in chunks(batch.column(1), _PIECE):
                line, at, first = _laid_out(part, order)
                n = len(part)
                score, _, rare_grams = held(entries, logs, np.repeat(np.arange(n), np.diff(first)), _keys(line, at, order + 1), n)
                data = lower(part.data)
                w = words(data, part.offsets)
                base, known_here, rare = held(known, gain, np.repeat(np.arange(n), w.counts), span_hashes(data, w.start, w.end), n)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(part.first, n), batch.column(2).slice(part.first, n),
                     pa.array(w.counts + 1), pa.array(known_here), pa.array(base), pa.array(score), rare_grams, rare],
                    ["doc_id", "held_out", "n_tokens", "known", "base", "score", "grams", "words"])
    return run


def _last(key: str, size: Column | int) -> Column:
    """The last ``size`` bytes of a key."""
    size = size if isinstance(size, Column) else F.lit(size)
    return F.col(key).bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), size * 8) - 1)


def _at_all_depths(keys: DataFrame, order: int) -> DataFrame:
    """``keys`` with every depth of a context, and what is left of the key there: the context and the byte that follows."""
    keys = keys.withColumn("depth", F.explode(F.sequence(F.lit(0), F.lit(order))))
    return keys.withColumn("key", _last("key", F.col("depth") + 1))


def learn(texts: DataFrame, p: PartialMatching, scratch: Scratch) -> tuple[DataFrame, DataFrame, int, int]:
    """The trie's contexts, the words' counts, and the numbers of texts and positions, from all rows of ``texts`` (one column).

    ``total`` and ``distinct`` of a context count all that followed it, pruned or not; ``kept`` are its entries, ``held`` and
    ``width`` their sum and number, and ``ruled`` is the sum of their counts in the next shorter context.
    """
    tally = texts.mapInArrow(_count(p.order), "kind int, key long, n long").groupBy("kind", "key").agg(F.sum("n").alias("n"))
    tally = scratch.keep(tally, "counts")
    grams = tally.where("kind = 0")
    # A text has one end mark, so these are the texts.
    ends = grams.where((F.col("key").bitwiseAND(0xFF)) == END).agg(F.sum("n")).first()[0] or 0
    positions = grams.agg(F.sum("n")).first()[0] or 0
    least = max(1, int(np.ceil(positions * p.share)))
    entries = _at_all_depths(grams, p.order).groupBy("depth", "key").agg(F.sum("n").alias("n"))
    # In the shorter context a byte was seen as often as in all, 256 at most, that are a byte longer.
    entries = entries.withColumn("shorter", F.sum("n").over(Window.partitionBy("depth", _last("key", F.col("depth")))))
    kept = lambda c: F.when(F.col("n") >= least, c)
    contexts = entries.groupBy("depth", F.shiftright("key", 8).alias("context")).agg(
        F.sum("n").alias("total"), F.count(F.lit(1)).alias("distinct"),
        F.collect_list(kept(F.struct(F.col("key").bitwiseAND(0xFF).cast("int").alias("symbol"), "n"))).alias("kept"),  # 256 at most
        F.sum(kept(F.col("n"))).alias("held"), F.count(kept(F.col("n"))).alias("width"), F.sum(kept(F.col("shorter"))).alias("ruled"))
    contexts = scratch.keep(contexts.where("width > 0"), "contexts")
    return contexts, tally.where("kind = 1").select("key", "n"), int(ends), int(positions)


def _direct() -> Column:
    """The log of what a context's counts are divided by, where it is the longest."""
    return F.log10(F.col("total") + F.col("distinct"))


def _frequent(contexts: DataFrame, order: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """The entries of the longest contexts that were seen ``least`` times, with their log-probabilities."""
    rows = contexts.where(F.col("depth") == order).select("context", _direct().alias("log"), F.explode("kept").alias("e"))
    key = (F.col("context") * 256).bitwiseOR(F.col("e.symbol"))
    rows = rows.where(F.col("e.n") >= least).select(key.alias("key"), (F.log10("e.n") - F.col("log")).alias("log")).toArrow()
    return rows.column("key").to_numpy().view(np.uint64), rows.column("log").to_numpy()


def _log_probabilities(keys: DataFrame, contexts: DataFrame, order: int, scratch: Scratch) -> DataFrame:
    """``key, log``: of the last byte of each distinct key, whose earlier bytes are its context."""
    back = contexts.select((F.col("depth") + 1).alias("depth"), F.col("context").alias("suffix"),
                           *[F.col(c).alias(f"back_{c}") for c in ("total", "distinct", "held")])
    # At most 256 contexts share the one that is a byte shorter.
    both = contexts.withColumn("suffix", _last("context", F.greatest(F.col("depth") - 1, F.lit(0))))
    both = both.join(back, ["depth", "suffix"], "left")
    rest = F.col("back_total") - F.col("ruled") + F.col("back_distinct") - F.col("width")
    free = F.col("back_total") - F.col("back_held") + F.col("back_distinct") - F.col("width")
    log = lambda x: F.log10(F.when(x > 0, x).otherwise(1))
    both = both.select(
        "depth", "context", "kept", _direct().alias("direct"), (log(F.col("total") - F.col("held") + F.col("distinct")) - _direct()).alias("escape"),
        log(rest).alias("rest"), F.when(rest > 0, log(free) - log(rest)).otherwise(0.0).alias("onward"))
    asked = _at_all_depths(keys, order).select("depth", "key").distinct().withColumn("context", F.shiftright("key", 8))
    symbol = F.col("key").bitwiseAND(0xFF)
    seen = F.get(F.filter("kept", lambda e: e["symbol"] == symbol), F.lit(0))["n"]
    facts = asked.join(both, ["depth", "context"], "left").select("depth", "key", "direct", "escape", "rest", "onward", F.log10(seen).alias("seen"))
    facts = scratch.keep(facts, "facts")
    root = contexts.where("depth = 0").select("width").first()
    uniform = F.lit(float(-np.log10(max(1, 256 - (root[0] if root else 0)))))
    # ``log`` takes the context for the longest, ``behind`` gives what its suffix says where it has not seen the byte.
    known, found = F.col("direct").isNotNull(), F.col("seen").isNotNull()
    for depth in range(order + 1):
        here = facts.where(F.col("depth") == depth)
        if depth == 0:
            here, behind, otherwise = here.withColumn("behind", uniform), F.col("behind"), uniform
        else:
            below = done.select(F.col("key").alias("cut"), F.col("seen").alias("seen_below"), F.col("behind_next").alias("b"), F.col("log").alias("a"))
            here = here.withColumn("cut", _last("key", depth)).join(below, "cut")
            behind, otherwise = F.coalesce(F.col("seen_below") - F.col("rest"), F.col("onward") + F.col("b")), F.col("a")
        value = F.when(~known, otherwise).when(found, F.col("seen") - F.col("direct")).otherwise(F.col("escape") + behind)
        done = here.select("key", "seen", behind.alias("behind_next"), value.alias("log"))
    return done.select("key", "log")


def language_scores(docs: DataFrame, held_out: Column, p: PartialMatching = PartialMatching(), scratch: Scratch | None = None) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row, learnt from those not held out.

    Texts count with A-Z in lower case, null as empty; ``score`` is the log10 probability of all their bytes and of their
    end. Tokens are words ``[^\\x20\\x09-\\x0D]+`` and one end. ``held_out`` is a condition on ``doc_id`` and ``text``; null counts
    as held out. Without training texts every byte has a probability of 1 in 256 and no token is known. Rows that
    repeat an id are scored by themselves; other columns do not matter.
    """
    spark = docs.sparkSession
    scratch = scratch or Scratch(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.withColumn("held_out", F.coalesce(held_out, F.lit(True)))
    contexts, terms, ends, positions = learn(rows.where("NOT held_out").select("text"), p, scratch)
    seen = terms.agg(F.sum("n"), F.count(F.lit(1))).first()
    total, vocabulary = (seen[0] or 0) + ends, seen[1] + (ends > 0)
    least = max(1, int(np.ceil(total * p.word_share)))
    # At most 1 / word_share words, and 1 / frequent entries.
    heavy = terms.where(F.col("n") >= least).toArrow()
    heavy = (heavy.column("key").to_numpy().view(np.uint64), heavy.column("n").to_numpy())
    frequent = _frequent(contexts, p.order, max(1, int(np.ceil(positions * p.frequent))))
    sc = spark.sparkContext
    run = _scores(sc.broadcast(frequent), sc.broadcast(heavy), total, vocabulary, p.order)
    counted = "array<struct<key:long,times:long>>"
    scored = rows.select("doc_id", "text", "held_out").mapInArrow(
        run, f"doc_id long, held_out boolean, n_tokens long, known long, base double, score double, grams {counted}, words {counted}")
    scored = scratch.keep(scored.withColumn("row", F.monotonically_increasing_id()), "scored")
    unit = F.lit(float(np.log10(total + 0.1 * (vocabulary + 1))))
    # Kind 0 are positions, kind 1 words, in the tables and among what is looked up.
    rare = [scored.select("row", F.lit(kind).alias("kind"), F.explode(name).alias("r")) for kind, name in enumerate(("grams", "words"))]
    rare = rare[0].union(rare[1]).select("row", "kind", F.col("r.key").alias("of_key"), "r.times")
    asked = scored.select(F.explode("grams").alias("r")).select("r.key").distinct()
    logs = _log_probabilities(asked, contexts, p.order, scratch)
    values = logs.select(F.lit(0).alias("of_kind"), "key", "log").union(
        terms.where(F.col("n") < least).select(F.lit(1), "key", F.log10(F.col("n") + F.lit(0.1)) - unit))
    rare = rare.join(values, (F.col("kind") == F.col("of_kind")) & (F.col("of_key") == F.col("key")), "left")
    word, none = F.col("kind") == 1, F.log10(F.lit(0.1)) - unit
    rare = rare.groupBy(F.col("row").alias("of")).agg(
        F.sum(F.when(word & F.col("log").isNotNull(), F.col("times")).otherwise(0)).alias("more"),
        F.sum(F.when(word, F.col("times") * F.coalesce("log", none)).otherwise(0.0)).alias("rest"),
        F.sum(F.when(~word, F.col("times") * F.col("log")).otherwise(0.0)).alias("scored"))
    full = scored.drop("grams", "words").join(rare, F.col("row") == F.col("of"), "left")
    end = F.log10(F.lit(float(ends)) + F.lit(0.1)) - unit
    return full.select(
        "doc_id", "held_out", "n_tokens",
        (F.col("known") + F.coalesce("more", F.lit(0)) + F.lit(int(ends > 0))).cast("long").alias("n_known"),
        F.lit(int(total)).cast("long").alias("train_tokens"), (F.col("base") + F.coalesce("rest", F.lit(0.0)) + end).alias("base_score"),
        (F.col("score") + F.coalesce("scored", F.lit(0.0))).alias("score"))
