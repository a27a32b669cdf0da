"""Conversation structure repair by iterative-deepening A*.

A conversation's roles should read ``(s?(ua)+)?`` (system, user, assistant, by initial). Each row is kept, given another
role or deleted, and rows are inserted; the cheapest edits are searched depth first, in the order of their initials D,
I, K, R, under rising cost bounds. States that failed keep a lower bound of what is left to pay from them, which every
later search uses, so the first path that is accepted is the cheapest and of those the ASCII-least.

A conversation may be of any length. Its rows lie in ranges; a range cuts it into chunks. For a chunk of a conversation
that is not wholly in one chunk, searches give the cost from each state before to each state after it. Products of
these 4 x 4 tables give what the rest of the conversation costs from every state after a chunk, with which each chunk is
searched on its own; its path from the state that the chunks before lead to is the answer. Every row of a chunk ends
in exactly one D, K or R and inserts come first, so no chunk's path begins another one, and the least parts make the least whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._store import Scratch, prepare

CHUNK_ROWS = 64
NO_PATH = 1 << 60
START, SYSTEM, USER, ASSISTANT = range(4)  # what the repaired rows so far end with
S, U, A, OTHER = range(4)  # a row's initial, the low bits of its kind
TRUNCATED, BLANK, DUPLICATE = 4, 8, 16
INSERT, REROLE, DELETE, SHORT = 3, 3, 4, 3
_AFTER = {(START, S): SYSTEM, (START, U): USER, (SYSTEM, U): USER, (USER, A): ASSISTANT, (ASSISTANT, U): USER}
_NEXT = {START: U, SYSTEM: U, USER: A, ASSISTANT: U}  # the role that may be put here
_FULL = {U: "user", A: "assistant"}
#: What is left to pay at the end of a conversation: rows are inserted up to the next assistant.
AT_END = (0, 2 * INSERT, INSERT, 0)
_WHITE = " \t\n\x0b\x0c\r"
_LEGAL = ("su", "ua", "au")
_CHUNKS = "conv string, part int, pos long, kinds binary, edits string, cost long, costs array<long>, through array<long>"
_REPAIRED = "conv_id long, at long, nth int, edit string, role string, text string"


class Search:
    """The cheapest edits of a few rows. ``exits`` is what the rest costs from each state after them."""

    def __init__(self, kinds: bytes, exits: tuple[int, ...] = AT_END):
        self.kinds, self.n = kinds, len(kinds)
        self.low = [[NO_PATH] * 4 for _ in range(self.n)] + [list(exits)]
        rest, free, run, last = min(exits), 0, 0, None
        for i in range(self.n - 1, -1, -1):
            k = kinds[i]
            if k & (BLANK | DUPLICATE):
                rest += DELETE
            elif k == last:  # of every two neighbours with one role, one has to change
                run += 1
                rest += INSERT if run % 2 == 0 else 0
            else:
                last, run = (k, 1) if k in (U, A) else (None, 0)
                if k & 3 in (U, A):
                    rest += SHORT if k & TRUNCATED else 0
                else:
                    rest += DELETE if k & TRUNCATED else REROLE
                    if k & 3 == S:
                        free = max(free, DELETE - SHORT if k & TRUNCATED else REROLE)  # one system row may stay
            self.low[i] = [rest - free, rest, rest, rest]

    def moves(self, i: int, q: int) -> Iterator[tuple[str, int, int, int]]:
        """The edits at a state in ASCII order: initial, cost, and the state that follows."""
        if i == self.n:
            return
        kind, put = self.kinds[i], _AFTER[q, _NEXT[q]]
        yield "D", DELETE, i + 1, q
        yield "I", INSERT, i, put
        if not kind & (BLANK | DUPLICATE):
            short = SHORT if kind & TRUNCATED else 0
            if (q, kind & 3) in _AFTER:
                yield "K", short, i + 1, _AFTER[q, kind & 3]
            yield "R", REROLE + short, i + 1, put

    def _descend(self, i: int, q: int, left: int) -> bool:
        if self.low[i][q] > left:
            return False
        if i == self.n:
            self.end = q
            return True
        least = NO_PATH
        for edit, cost, j, p in self.moves(i, q):
            self.path.append(edit)
            if self._descend(j, p, left - cost):
                return True
            self.path.pop()
            least = min(least, cost + self.low[j][p])
        self.low[i][q] = least  # failed: at least this is left to pay from here
        return False

    def best(self, q: int) -> tuple[int, str, int]:
        """Cost (that of the rest included), edits and the state after them, from state ``q``."""
        self.path: list[str] = []
        bound = self.low[0][q]
        while bound < NO_PATH and not self._descend(0, q, bound):
            bound = self.low[0][q]
        return bound, "".join(self.path), self.end if bound < NO_PATH else q


def costs(kinds: bytes) -> list[int]:
    """The cost from each state before some rows to each state after them, 16 numbers row by row; ``NO_PATH`` if it cannot be."""
    out = []
    system = any(not k & (BLANK | DUPLICATE) and k & 3 == S for k in kinds)
    searches = [Search(kinds, tuple(0 if p == q else NO_PATH for p in range(4))) for q in range(4)]
    for q in range(4):
        for p in range(4):
            reached = p in (USER, ASSISTANT) or p == q or (p == SYSTEM and q == START and system)
            out.append(searches[p].best(q)[0] if reached else NO_PATH)
    return out


def through(first: list[int], then: list[int]) -> list[int]:
    """The costs of two stretches in a row."""
    return [min(NO_PATH, min(first[4 * q + m] + then[4 * m + p] for m in range(4))) for q in range(4) for p in range(4)]


def before(table: list[int], exits: list[int] | tuple[int, ...]) -> list[int]:
    """What the rest costs from each state before a stretch, given what it costs after it."""
    return [min(NO_PATH, min(table[4 * q + p] + exits[p] for p in range(4))) for q in range(4)]


def _chunks(size: int):
    names = [x.split()[0] for x in _CHUNKS.split(", ")]
    types = [pa.string(), pa.int32(), pa.int64(), pa.binary(), pa.string(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())]

    def run(batches):
        part, out = TaskContext.get().partitionId(), []
        conv, kinds, begin, so_far, first = None, bytearray(), 0, None, True

        def close(ended: bool):
            nonlocal so_far
            rows = bytes(kinds)
            if ended and so_far is None and not first:  # the conversation is here from end to end
                cost, edits, state = Search(rows).best(START)
                out.append((conv, part, begin, rows, edits + "I" * (AT_END[state] // INSERT), cost, None, None))
                return
            own = costs(rows)
            so_far = own if so_far is None else through(so_far, own)
            out.append((conv, part, begin, rows, None, None, own, so_far))
        for batch in batches:
            for c, pos, kind in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                if kinds and c != conv:
                    close(True)
                    kinds.clear()
                    so_far, first = None, False
                elif len(kinds) == size:
                    close(False)
                    kinds.clear()
                if not kinds:
                    conv, begin = c, pos
                kinds.append(kind)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), types, strict=True)], names)
                out.clear()
        if kinds:
            close(False)
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), types, strict=True)], names)
    return run


def _exits(table: pa.Table) -> pa.Table:
    """For the stretches of one conversation, what the rest costs from each state after each of them."""
    rows, exits, out = sorted(table.to_pylist(), key=lambda r: r["part"]), list(AT_END), []
    for k, r in reversed(list(enumerate(rows))):
        cost = before(r["through"], exits)
        out.append({"conv": r["conv"], "part": r["part"], "first": k == 0, "last": k == len(rows) - 1, "exits": exits, "cost": cost[START]})
        exits = cost
    return pa.Table.from_pylist(out, _EXITS_ARROW)


_EXITS = "conv string, part int, first boolean, last boolean, exits array<long>, cost long"
_EXITS_ARROW = pa.schema([("conv", pa.string()), ("part", pa.int32()), ("first", pa.bool_()), ("last", pa.bool_()),
                          ("exits", pa.list_(pa.int64())), ("cost", pa.int64())])
_PATHS = "conv string, part int, pos long, state int, edits string, leads_to int"
_PATHS_ARROW = pa.schema([("conv", pa.string()), ("part", pa.int32()), ("pos", pa.int64()), ("state", pa.int32()),
                          ("edits", pa.string()), ("leads_to", pa.int32())])
_CHAIN = "conv string, part int, state int"
_CHAIN_ARROW = pa.schema([("conv", pa.string()), ("part", pa.int32()), ("state", pa.int32())])


def _paths(table: pa.Table) -> pa.Table:
    """The chunks of one stretch: their edits, for each state that the stretch may begin in, and the state it leads to."""
    rows = sorted(table.to_pylist(), key=lambda r: r["pos"])
    exits, out = [tuple(rows[0]["exits"])], []
    for r in reversed(rows):
        exits.append(tuple(before(r["costs"], exits[-1])))
    exits.reverse()
    searches = [Search(r["kinds"], exits[k + 1]) for k, r in enumerate(rows)]
    for state in [START] if rows[0]["first"] else range(4):
        if exits[0][state] >= NO_PATH:
            continue
        q, paths = state, []
        for search in searches:
            _, edits, q = search.best(q)
            paths.append(edits)
        if rows[0]["last"]:
            paths[-1] += "I" * (AT_END[q] // INSERT)
        out += [{"conv": r["conv"], "part": r["part"], "pos": r["pos"], "state": state, "edits": e, "leads_to": q}
                for r, e in zip(rows, paths, strict=True)]
    return pa.Table.from_pylist(out, _PATHS_ARROW)


def _chain(table: pa.Table) -> pa.Table:
    """The state in which each stretch of one conversation begins."""
    leads = {(r["part"], r["state"]): r["leads_to"] for r in table.to_pylist()}
    conv, state, out = table.column("conv")[0].as_py(), START, []
    for part in sorted({part for part, _ in leads}):
        out.append({"conv": conv, "part": part, "state": state})
        state = leads[part, state]
    return pa.Table.from_pylist(out, _CHAIN_ARROW)


@dataclass
class Structure:
    """Stored tables of one run: rows in order, their kinds, and the edits of each chunk."""

    rows: DataFrame  # conv, conv_id, at, turn, role, text
    kinds: DataFrame  # conv, at, kind
    edits: DataFrame  # conv, at, edits
    cost: DataFrame  # conv, cost


def _key(conv_id: F.Column) -> F.Column:
    return F.coalesce(conv_id.cast("string"), F.lit(""))


def structure(turns: DataFrame, scratch: Scratch | None = None, chunk_rows: int = CHUNK_ROWS) -> Structure:
    """Faults and cheapest edits of all conversations (``conv_id, turn, role, text``; other columns are ignored).

    Null roles and texts are one space, null conversations are one conversation, null turns come first. A row whose role is
    empty has no initial, so it is not kept as it is. Rows of one turn are ordered by role and a digest of the text; rows that
    are equal in all may lie in several ranges.
    """
    spark = turns.sparkSession
    scratch = scratch or Scratch(spark)
    rows = turns.select(_key(F.col("conv_id")).alias("conv"), F.col("conv_id").cast("long").alias("conv_id"),
                        F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
                        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"))
    order = ["conv", "turn", "role", "digest", "spread"]
    rows = rows.withColumn("digest", F.unhex(F.md5("text"))).withColumn("spread", F.monotonically_increasing_id())
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("spread")
    rows = scratch.keep(rows.withColumn("at", F.monotonically_increasing_id()), "rows")

    blank = F.length(F.rtrim("text", F.lit(_WHITE))) == 0
    short = ~F.right(F.rtrim("text", F.lit(_WHITE)), F.lit(1)).isin(".", "!", "?")
    first = F.substring("role", 1, 1)
    initial = F.when(first == "s", S).when(first == "u", U).when(first == "a", A).otherwise(OTHER)
    said = rows.select("conv", "role", "digest", "at", blank.alias("blank"))
    earliest = said.where(~F.col("blank")).groupBy("conv", "role", "digest").agg(F.min("at").alias("at")).select("at", F.lit(True).alias("new"))
    kind = rows.select("conv", "at", initial.alias("initial"), blank.alias("blank"), short.alias("short")).join(earliest, "at", "left")
    kind = kind.select("conv", "at", (F.col("initial") + F.when(F.col("blank"), BLANK).when(F.col("new").isNull(), DUPLICATE)
                                      .when(F.col("short"), TRUNCATED).otherwise(0)).cast("int").alias("kind"))
    kind = scratch.keep(kind, "kinds")

    ranges = kind.select("conv", "at", "kind").repartitionByRange("at").sortWithinPartitions("at")
    chunks = scratch.keep(ranges.mapInArrow(_chunks(chunk_rows), _CHUNKS), "chunks")
    cut = chunks.where("edits IS NULL")
    stretches = cut.groupBy("conv", "part").agg(F.max_by("through", "pos").alias("through"))
    exits = scratch.keep(stretches.groupBy("conv").applyInArrow(_exits, _EXITS), "exits")
    paths = cut.select("conv", "part", "pos", "kinds", "costs").join(exits.select("conv", "part", "first", "last", "exits"), ["conv", "part"])
    paths = scratch.keep(paths.groupBy("conv", "part").applyInArrow(_paths, _PATHS), "paths")
    chain = paths.select("conv", "part", "state", "leads_to").distinct().groupBy("conv").applyInArrow(_chain, _CHAIN)
    edits = chunks.where("edits IS NOT NULL").select("conv", F.col("pos").alias("at"), "edits")
    edits = edits.union(paths.join(chain, ["conv", "part", "state"]).select("conv", F.col("pos").alias("at"), "edits"))
    cost = chunks.where("edits IS NOT NULL").select("conv", "cost").union(exits.where("first").select("conv", "cost"))
    return Structure(rows, kind, edits, cost)


def _in_order(found: Structure) -> DataFrame:
    """Rows of each conversation in order, each chunk's edits before its rows; a conversation is in one task, which streams it."""
    rows = found.rows.select("conv", "at", F.lit(None).cast("string").alias("edits"), "conv_id", "role", "text")
    edits = found.edits.select("conv", "at", "edits", F.lit(None).cast("long"), F.lit(None).cast("string"), F.lit(None).cast("string"))
    both = rows.union(edits).repartition("conv").sortWithinPartitions("conv", "at", F.col("edits").asc_nulls_last())
    return both.select("conv", "at", "edits", "conv_id", "role", "text")


class Editor:
    """Follows the edits of one conversation through its rows."""

    def __init__(self) -> None:
        self.state, self.edits, self.done = START, "", 0

    def insert(self) -> Iterator[tuple[str, str, str]]:
        while self.done < len(self.edits) and self.edits[self.done] == "I":
            yield self._put("I", "")

    def follow(self, edits: str) -> Iterator[tuple[str, str, str]]:
        yield from self.insert()
        self.edits, self.done = edits, 0

    def row(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        """``edit, role, text`` of what becomes of the next row, insertions before it included; role is None if it goes."""
        yield from self.insert()
        edit = self.edits[self.done]
        if edit == "R":
            yield self._put("R", text)
            return
        self.done += 1
        if edit == "K":
            self.state = _AFTER[self.state, "sua".index(role[0])]
            yield "K", role, text
        else:
            yield "D", None, None

    def _put(self, edit: str, text: str) -> tuple[str, str, str]:
        self.done += 1
        role = _NEXT[self.state]
        self.state = _AFTER[self.state, role]
        return edit, _FULL[role], text


def _events(batches) -> Iterator[tuple[str, int | None, int, str | None, Iterator[tuple[str, str, str]]]]:
    """For each stored row or end of a conversation: its key, its id (known once a row came), its place, its role, and the edits made."""
    conv, conv_id, at, editor = None, None, 0, Editor()
    for batch in batches:
        for c, here, edits, number, role, text in zip(*(x.to_pylist() for x in batch.columns), strict=True):
            if c != conv:
                if conv is not None:
                    yield conv, conv_id, at, None, editor.insert()
                conv, editor = c, Editor()
            if edits is not None:
                yield conv, conv_id, at, None, editor.follow(edits)
            else:
                conv_id, at = number, here
                yield conv, conv_id, at, role, editor.row(role, text)
    if conv is not None:
        yield conv, conv_id, at, None, editor.insert()


def _repaired(batches):
    names, out = [x.split()[0] for x in _REPAIRED.split(", ")], []
    types = [pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.string(), pa.string()]
    last, nth, size = None, 0, 0
    for _, conv_id, at, _, made in _events(batches):
        for edit, role, text in made:
            if role is None:
                continue
            nth = nth + 1 if at == last else 0
            last = at
            out.append((conv_id, at, nth, edit, role, text))
            size += len(text)
        if len(out) >= 1000 or size > 1 << 20:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), types, strict=True)], names)
            out, size = [], 0
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), types, strict=True)], names)


def repaired_turns(found: Structure) -> DataFrame:
    """The rows of the repaired conversations: ``conv_id, at, nth, edit, role, text``, in order by ``at`` and ``nth``.

    Conversations without rows have none; deleted rows are left out.
    """
    return _in_order(found).mapInArrow(_repaired, _REPAIRED)


_DIGESTS = "conv string, illegal long, audit string, repaired_sha256 string"


def _digest(batches):
    names = [x.split()[0] for x in _DIGESTS.split(", ")]
    conv, state = None, None

    def out():
        illegal, _, audit, digest, _ = state
        return pa.RecordBatch.from_arrays([pa.array([conv]), pa.array([illegal], pa.int64()), pa.array(["".join(audit)]),
                                           pa.array([digest.hexdigest()])], names)
    for c, _, _, said, made in _events(batches):
        if c != conv:
            if state is not None:
                yield out()
            conv, state = c, [0, None, [], hashlib.sha256(), 0]
        for edit, role, text in made:
            state[2].append(edit)
            if role is not None:
                state[3].update(f"{chr(10) if state[4] else ''}{role}:{text}".encode())
                state[4] += 1
        if said is not None:
            state[0] += state[1] is not None and state[1] + said[:1] not in _LEGAL
            state[1] = said[:1]
    if state is not None:
        yield out()


def repaired(turns: DataFrame, original: DataFrame | None = None, scratch: Scratch | None = None,
             chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """One row per conversation: its faults, the cheapest edits, and a digest of what they give.

    ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256``. A row's first fault counts: blank, role
    and text seen earlier, not ended by a mark. ``gaps`` counts missing turn numbers, ``illegal`` neighbouring rows whose roles do not
    follow each other. ``original`` adds conversations that have no rows (any more): zeros and an empty text.
    See ``structure`` for nulls and ties; ``chunk_rows`` changes no result.
    """
    found = structure(turns, scratch, chunk_rows)
    distinct = found.rows.groupBy("conv", "turn").agg(F.lit(1).alias("one")).groupBy("conv").agg(
        F.max("turn").alias("high"), F.min("turn").alias("low"), F.count("turn").alias("n"))
    wide = F.col("high").cast("decimal(38,0)") - F.col("low").cast("decimal(38,0)") + 1 - F.col("n")
    gaps = distinct.select("conv", F.coalesce(wide, F.lit(0)).cast("long").alias("gaps"))
    fault = {"blank": BLANK, "duplicate": DUPLICATE, "truncated": TRUNCATED}
    faults = found.kinds.groupBy("conv").agg(*(F.sum((F.col("kind").bitwiseAND(bit) != 0).cast("long")).alias(name)
                                               for name, bit in fault.items()))
    digests = _in_order(found).mapInArrow(_digest, _DIGESTS)
    ids = (turns if original is None else original).select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    out = ids.withColumn("conv", _key(F.col("conv_id")))
    for more in (gaps, faults, found.cost, digests):
        out = out.join(more, "conv", "left")
    zero = [F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in ("gaps", *fault, "illegal", "cost")]
    return out.select("conv_id", *zero, F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))
