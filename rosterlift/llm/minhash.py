"""Near-duplicate documents by bottom-k sketches.

Every document's shingles are hashed once; its sketch is the ``k`` smallest hashes. Texts of equal shingle sets form a
class and go on as one. Inverted lists of the retained values bring classes together, the sketch of the union
estimates their similarity, and pairs that pass are confirmed on the full sets; links are joined into components.

Which values are indexed. The sketch of a union holds ``k`` values, and with similarity ``t`` each of them lies in both
sets with probability ``t`` or more. ``least`` is set so that fewer than that many common values have a probability
under 1e-6. Two sketches that share ``least`` values still meet in one of their ``k - least + 1`` rarest values, so only
those are listed: passages that many documents quote hardly ever are. Values that one class alone holds count among the
rarest and need no list at all.

Large lists. No list emits all its pairs. A first round ties most copies together by the few rarest values of each class.
In every further round some members of a list, its pivots, are compared with the
members of other components; a pivot is then done with. Copies of one text fall into one component early, as the first
pivots are the members that share most with the others. Only lists whose members still lie in several components
go on, with eight times the pivots, and no pair is fetched twice. Every pair of a list is thus compared or already connected: nothing is capped. The
comparison begins inside the join, and in one of the lists that two members share: a longer sketch of each set is kept as bits, a bit
for each value modulo 1024, and the bits that two members share bound the estimate from the sketch of their union. Members that merely quote the same
passage, or are near but not near enough, make no rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import one_per_key
from ._graph import joined
from ._store import Scratch
from ._text import chunks, lower, shingle_hashes, span_hashes, words

_FIRST = 4  # values of each class in the first round, and pivots of the first two
_POSITIVE = np.uint64(2**63 - 1)
_HELD = 256  # values of a set by which the similarity of a pair is estimated before its whole sets are fetched
_WORDS = 16  # of 64 bits, for the bits of these values


@dataclass(frozen=True)
class NearDuplicates:
    """``percent``: documents are linked when 100 * intersection >= percent * union of their shingle sets."""

    shingle: int = 5
    percent: int = 80
    k: int = 64
    pivots: int = 16

    def least(self, k: int) -> int:
        """The largest count that a binomial(k, percent) variable misses with a probability below 1e-6."""
        t, low = self.percent / 100, 0.0
        for m in range(k + 1):
            low += math.comb(k, m) * t**m * (1 - t)**(k - m)
            if low > 1e-6:
                return max(1, m)
        return max(1, k)

    def common(self, n) -> Column:
        """How many values two sketches share at least, the larger set having ``n``."""
        return F.least(F.lit(self.least(self.k)), F.ceil(n * self.percent / 100).cast("int"))

    def common_kept(self, larger: Column, smaller: Column) -> Column:
        """How many of their kept values two linked sets of these sizes share at least, but for one pair in a million.

        Their intersection makes up a certain part of the larger set. Of the values kept of that set as many are expected
        in both, less five standard deviations and a half if not all are kept.
        """
        part = (larger + smaller) / larger * (self.percent / (100 + self.percent))
        kept = F.least(larger, F.lit(_HELD))
        spread = F.when(larger > _HELD, 5.5 * F.sqrt(kept * part * F.greatest(1 - part, F.lit(0.01)))).otherwise(0.0)
        return kept * part - spread - 0.001


def shingle_sets(column: pa.Array, size: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text, as 63-bit numbers."""
    for part in chunks(column):
        data = lower(part.data)
        w = words(data, part.offsets)
        hashes, begin = shingle_hashes(span_hashes(data, w.start, w.end), w.first, size)
        hashes &= _POSITIVE
        for i in range(len(part)):
            yield np.unique(hashes[begin[i]:begin[i + 1]])


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, arrays)])
    flat = np.concatenate([*arrays, np.zeros(0, np.uint64)]).astype(np.int64)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))


def _sketches(size: int, k: int):
    def run(batches):
        for batch in batches:
            sets = list(shingle_sets(batch.column(1), size))
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([len(s) for s in sets], pa.int64()),
                pa.array([_digest(s) if len(s) else None for s in sets], pa.binary()),
                _lists([s[:k] for s in sets])], ["doc_id", "n_shingles", "class", "sketch"])
    return run


def _bits(values: np.ndarray) -> np.ndarray:
    marks = np.zeros(_WORDS * 64, np.uint8)
    marks[(values % np.uint64(_WORDS * 64)).astype(int)] = 1
    return np.packbits(marks).view(np.uint64)


def _digest(values: np.ndarray) -> bytes:
    return hashlib.blake2b(values.tobytes(), digest_size=16).digest()


def _full_sets(size: int):
    """The sets of the classes; of several texts of one id those of the class."""
    def run(batches):
        for batch in batches:
            rows = batch.num_rows
            for at in range(0, rows, 200):
                part = batch.slice(at, 200)
                sets = list(shingle_sets(part.column(1), size))
                own = [_digest(s) == c for s, c in zip(sets, part.column(0).to_pylist(), strict=True)]
                part, sets = part.filter(pa.array(own)), [s for s, o in zip(sets, own, strict=True) if o]
                bits = [_bits(s[:_HELD]) for s in sets]
                doubled = [min(len(s), _HELD) - int(np.bitwise_count(b).sum()) for s, b in zip(sets, bits, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([len(s) for s in sets], pa.int64()), _lists(sets),
                                                  _lists(bits), pa.array(doubled, pa.int64())], ["class", "n", "shingles", "bits", "doubled"])
    return run


def _listed(classes: DataFrame, p: NearDuplicates) -> DataFrame:
    """The inverted lists: ``value, class, node, weight, rank``, for the rarest values that several classes retain, and the ``rarer`` values
    of the class that have lists too."""
    # The short id keeps the many rows small; should two classes share one, both get the lists of both.
    short = F.conv(F.hex(F.substring("class", 1, 7)), 16, 10).cast("long")
    classes = classes.withColumn("short", short)
    values = classes.select("short", F.explode("sketch").alias("value"))
    shared = values.groupBy(F.struct("value").alias("v")).agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    shared = shared.select(F.col("v.value").alias("shared"), "df")
    found = values.join(shared, F.col("value") == F.col("shared")).groupBy(F.col("short").alias("of")).agg(
        F.sum("df").alias("weight"), F.sort_array(F.collect_list(F.struct("df", "value"))).alias("common"))
    found = found.join(classes.withColumn("held", F.size("sketch")).drop("sketch"), F.col("of") == F.col("short"))
    # The values that no one else has come first in the order by rarity.
    take = F.size("common") - p.common(F.col("n")) + 1
    found = found.withColumn("take", F.least(take, F.size("common"))).where("take > 0")
    found = found.withColumn("listed", F.transform(F.slice("common", F.lit(1), F.greatest("take", F.lit(0))), lambda c: c["value"]))
    found = found.select("class", "node", "weight", "listed", F.posexplode("listed").alias("rank", "value"))
    return found.select("value", "class", "node", "weight", "rank", F.slice("listed", F.lit(1), F.col("rank")).alias("rarer"))


def _linked(lists: DataFrame, sets: DataFrame, p: NearDuplicates, scratch: Scratch) -> DataFrame | None:
    """The component of every node that has a confirmed link; None if no list has two members."""
    where, tested, many, turn = None, None, p.pivots, 0
    bits = [f"b{i}" for i in range(_WORDS)]  # columns of their own: a join condition reads them without unpacking an array
    facts = ["value", "class", "node", "weight", "rarer", "n", "doubled", *bits]
    every = lists.join(sets.select("class", "n", "doubled", *[F.col("bits")[i].alias(b) for i, b in enumerate(bits)]), "class")
    left = every.where(F.col("rank") < _FIRST)
    while True:
        turn += 1
        if where is not None:
            at = where.select(F.col("node").alias("at"), "component")
            left = left.join(at, F.col("node") == F.col("at"), "left").drop("at")
            left = left.withColumn("component", F.coalesce("component", "node"))
            mixed = left.groupBy(F.struct("value").alias("v")).agg(F.min("component").alias("a"), F.max("component").alias("b"))
            left = left.join(mixed.where("a < b").select(F.col("v.value").alias("value")), "value", "left_semi")
            own = left.groupBy(F.struct("value", "component").alias("v")).agg(F.count(F.lit(1)).alias("own"))
            own = own.select(F.col("v.value").alias("ov"), F.col("v.component").alias("oc"), "own")
            left = left.join(own, (F.col("value") == F.col("ov")) & (F.col("component") == F.col("oc"))).drop("ov", "oc")
        else:
            left = left.withColumn("component", F.col("node")).withColumn("own", F.lit(1).cast("long"))
        # At first members of the common components, to which most others belong. Then those of the rarer ones, so that
        # few pivots are left to compare with the common one's.
        order = Window.partitionBy("value").orderBy(F.desc("own") if turn == 2 else F.col("own"), F.desc("weight"), "class")
        few = _FIRST if turn <= 2 else many
        left = scratch.keep(left.withColumn("turn", F.row_number().over(order)), f"left-{turn}")
        scratch.drop(f"left-{turn - 1}")
        scratch.release()
        if left.isEmpty():
            scratch.drop(*[f"pairs-{t}" for t in range(1, turn)])
            return where
        pairs = _met(left, few, [*facts, "component"], bits, p).distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = scratch.keep(pairs, f"pairs-{turn}")
        tested = pairs if tested is None else tested.union(pairs)
        found = scratch.keep(_confirmed(pairs, sets, p), f"links-{turn}")
        if turn == 1 or not found.isEmpty():
            where = joined(where, found, scratch, f"components-{turn}")
        scratch.drop(f"links-{turn}")
        if turn == 1:  # its lists were partial, so no pivot is done with
            left = every.select(*facts)
        else:
            left = left.where(F.col("turn") > few).select(*facts)
            many *= 8 if turn > 2 else 1


def _met(left: DataFrame, few: int, facts: list[str], bits: list[str], p: NearDuplicates) -> DataFrame:
    """Pairs (a, b) of the lists' pivots, their ``few`` first members, with members of other components that may be near.

    A pair makes a row in the first list in which either is a pivot, not in all that the two share (and a second one at most, if each is a
    pivot somewhere): members of a list know which rarer ones they are in, and pivots in which of these they are pivots.
    """
    before = Window.partitionBy("class").orderBy(F.size("rarer")).rowsBetween(Window.unboundedPreceding, -1)
    chosen = left.where(F.col("turn") <= few).withColumn("before", F.collect_list("value").over(before))
    chosen = chosen.select(*[F.col(c).alias(f"p_{c}") for c in (*facts, "turn", "before") if c != "rarer"])
    shared = F.lit(0)
    for b in bits:
        shared = shared + F.bit_count(F.col(b).bitwiseAND(F.col(f"p_{b}")))
    larger, smaller = F.greatest("n", "p_n"), F.least("n", "p_n")
    # Shared values take a bit each, but for those that share one within a set.
    least = p.common_kept(larger, smaller) - F.least("doubled", "p_doubled")
    near = (smaller * 100 >= larger * p.percent) & (shared >= least)
    first = (F.col("p_turn") < F.col("turn")) & ~F.arrays_overlap("rarer", "p_before")
    pairs = left.join(chosen, (F.col("value") == F.col("p_value")) & (F.col("component") != F.col("p_component")) & near & first)
    a, b = F.struct("class", "node"), F.struct(F.col("p_class").alias("class"), F.col("p_node").alias("node"))
    return pairs.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))


def _confirmed(pairs: DataFrame, sets: DataFrame, p: NearDuplicates) -> DataFrame:
    """The nodes (u, v) of pairs whose whole sets are similar enough."""
    pairs = pairs.select(F.col("a.class").alias("ca"), F.col("a.node").alias("u"), F.col("b.class").alias("cb"), F.col("b.node").alias("v"))
    for side in ("a", "b"):
        pairs = pairs.join(sets.select(F.col("class").alias(f"c{side}"), F.col("n").alias(f"n{side}"), F.col("shingles").alias(f"s{side}")), f"c{side}")
    pairs = pairs.withColumn("cut", F.size(F.array_intersect("sa", "sb")))
    return pairs.where(F.col("cut") * 100 >= p.percent * (F.col("na") + F.col("nb") - F.col("cut"))).select("u", "v")


def near_duplicates(docs: DataFrame, p: NearDuplicates = NearDuplicates(), id_col: str = "doc_id",
                    text_col: str = "text", scratch: Scratch | None = None) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs``.

    Words are ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z in lower case. Fewer words than a shingle has form one shingle
    together; a null, empty or blank text has none and is linked with nothing. A component's id is its smallest id, and
    the row that has it is kept. Rows with a null id take no part: ``component_id`` is null and they are kept. Rows
    that repeat an id are classed by their own texts. Other columns, of whatever name, are ignored.
    """
    spark = docs.sparkSession
    scratch = scratch or Scratch(spark)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    every = texts.mapInArrow(_sketches(p.shingle, p.k), "doc_id long, n_shingles long, class binary, sketch array<long>")
    every = scratch.keep(every, "sketched")
    known = every.where("class IS NOT NULL AND doc_id IS NOT NULL")
    classes = known.groupBy("class").agg(F.min("doc_id").alias("node"), F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch"))
    classes = scratch.keep(classes, "classes")
    lists = scratch.keep(_listed(classes, p), "lists")
    # Full sets only of the classes that some list holds, from the text of one document each.
    needed = lists.select("class", "node").distinct()
    one = texts.join(needed.select(F.col("node").alias("doc_id"), "class"), "doc_id")
    sets = one.select("class", "text").mapInArrow(_full_sets(p.shingle), "class binary, n long, shingles array<long>, bits array<long>, doubled long")
    sets = scratch.keep(sets, "sets")
    where = _linked(lists, sets, p, scratch)
    of_class = classes.select("class", "node")
    if where is not None:
        of_class = of_class.join(where, "node", "left")
        of_class = of_class.select("class", F.coalesce("component", "node").alias("component_id"))
    else:
        of_class = of_class.withColumnRenamed("node", "component_id")
    of_class = scratch.keep(of_class, "of-class")
    scratch.drop("classes", "lists", "sets")
    linked = every.drop("sketch").join(of_class, "class", "left")
    linked = linked.withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")))
    kept = F.col("doc_id").isNull() | (F.col("doc_id") == F.col("component_id"))
    return linked.select("doc_id", "n_shingles", "component_id", kept.alias("kept"))


def one_of_each(docs: DataFrame, p: NearDuplicates = NearDuplicates(), scratch: Scratch | None = None) -> DataFrame:
    """One row of ``docs`` (doc_id, text, ...) for each group of near duplicates, with all its columns.

    Of a group the row with the smallest id stays, as in ``near_duplicates``. Rows that repeat an id are documents of their own: one goes
    only if its own text is near another's, and of equals in id one stays. Rows without an id or
    without words stay.
    """
    scratch = scratch or Scratch(docs.sparkSession)
    keyed = docs.select(F.struct("*").alias("row")).withColumn("key", F.monotonically_increasing_id())
    keyed = scratch.keep(keyed, "keyed")
    known = keyed.where("row.doc_id IS NOT NULL").select(F.col("key").alias("doc_id"), F.col("row.text").alias("text"))
    groups = near_duplicates(known, p, scratch=scratch).select(F.col("doc_id").alias("key"), F.col("component_id").alias("group"))
    # Groups go by row keys; of each the row with the smallest id stays. Rows alone in their group need no look at their ids.
    shared = groups.where("key <> group").select("group").distinct()
    members = groups.join(shared, "group", "left_semi")
    rank = F.struct(F.col("row.doc_id").cast("long"), F.xxhash64("row.text"), "key").alias("rank")
    members = scratch.keep(members.join(keyed.select("key", rank), "key"), "members")
    first = one_per_key(members, [F.col("group")], F.min("rank").alias("first"))
    gone = members.join(first, "group").where("rank > first").select("key")
    return keyed.join(gone, "key", "left_anti").select("row.*")
