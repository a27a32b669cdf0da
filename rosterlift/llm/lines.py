"""Line dedup: an edit-distance join of all lines, by segments. SQL functions only.

Equal lines are one line with several copies. A line is split into ``edits + 1`` segments; if another line is within
``edits`` of it, one segment is found unchanged in that line, near where it was. The segments of every line are listed
under a key of length, number and content; every line looks up its own substrings at the places that the difference of
lengths allows (for a segment number i of a line that is d shorter: at most i - 1 places away from where it was, and at most
edits + 1 - i places away from where it was counted from the end). Lines that share a key are compared: first by
how often some characters occur, then by edit distance.

Verification is a banded bit-parallel edit distance: a column of the distance matrix is held as the differences of
its 2 * edits + 1 cells around the diagonal, each set of differences in the bits of one number, and goes to the next column
in a fixed number of word operations. It covers what is left when equal beginnings and ends are cut off; see
``with_line_distance`` for what is done where that is long.

Lines that share a key of up to ``pivots`` lines are paired at once. Longer lists are gone through in rounds: some of a
list's lines, more in every round, are paired with those of other components that look it up and have nearly the same
characters, until all its lines lie in one component or have been paired: no list emits all its pairs, and none is cut short.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._graph import components, joined
from ._store import Scratch


@dataclass(frozen=True)
class LineRules:
    edits: int = 2
    least: int = 20  # characters of a line that is compared by edit distance
    pivots: int = 16
    short: bool = True  # shorter lines that are not blank take part as exact copies: two edits make other words of them


_WORD = r"[^\x20\x09-\x0D]"


def occurrences(docs: DataFrame, least: int, id_col: str = "doc_id", text_col: str = "text", short: bool = False,
                own: list[str] | None = None) -> DataFrame:
    """``doc_id, line_no, line`` of every line of ``least`` characters or more; lines are what ``\\n`` separates, from 0.

    ``short``: and of shorter ones that are not blank. ``own`` may add ``text_key``, the hash of the whole text.
    """
    own = own or []
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.withColumn("text_key", F.xxhash64("text")) if own else rows
    rows = rows.select("doc_id", *own, F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"))
    long = F.char_length("line") >= least
    return rows.where(long | F.col("line").rlike(_WORD) if short else long)


def line_key(line: Column | str) -> Column:
    """Identity of a line: 64 bits, so equal up to collisions of about n^2 / 2^65."""
    return F.xxhash64(line)


_COUNTED = "etan "  # characters whose numbers are compared before the lines are


def _classes(line: Column) -> Column:
    """How often each counted character occurs, modulo 4096, side by side in one number."""
    total = F.lit(0).cast("long")
    for i, char in enumerate(_COUNTED):
        n = F.char_length(line) - F.char_length(F.replace(line, F.lit(char), F.lit("")))
        total = total + F.shiftleft((n % 4096).cast("long"), 12 * i)
    return total


def _may_be_near(a: Column, b: Column, edits: int) -> Column:
    """An edit changes two of the numbers by one at most."""
    off = F.lit(0)
    for i in range(len(_COUNTED)):
        d = F.pmod(F.shiftright(a, 12 * i).bitwiseAND(4095) - F.shiftright(b, 12 * i).bitwiseAND(4095), F.lit(4096))
        off = off + F.least(d, 4096 - d)
    return off <= 2 * edits


def line_keys(lines: DataFrame, edits: int) -> DataFrame:
    """id, classes of every line (id, line, classes), with its keys, a row each, and their ``kind``.

    Under its segments (kind 0) it is listed, and lines of its own length are looked up; under substrings at other places
    (kind 1) it only looks up lines that are as long or at most ``edits`` shorter. Segments are of even sizes, the last ones
    a character longer.
    """
    parts = edits + 1
    places = [(d, i, off) for d in range(edits + 1) for i in range(1, parts + 1)  # i: segment of lines that are d shorter
              for off in range(max(1 - i, d - (parts - i)), min(i - 1, d + parts - i) + 1)]
    places = F.array(*[F.struct(F.lit(d).alias("d"), F.lit(i).alias("i"), F.lit(off).alias("off")) for d, i, off in places])
    rows = lines.withColumn("n", F.char_length("line")).select("*", F.explode(places).alias("p")).select("*", "p.*")
    length, i, off = F.col("n") - F.col("d"), F.col("i"), F.col("off")
    rows = rows.where(length >= parts)
    size, short = F.floor(length / parts).cast("int"), F.lit(parts) - length % parts  # of a segment; how many are no longer
    start = size * (i - 1) + F.greatest(i - 1 - short, F.lit(0)) + off
    content = F.substring("line", start + 1, size + F.when(i > short, 1).otherwise(0))
    # A substring that begins before the line, or ends behind it, is no segment's; its key then lists nothing.
    kind = F.when((F.col("d") == 0) & (off == 0), 0).otherwise(1)
    return rows.select("id", "classes", F.xxhash64(length, i, content).alias("key"), kind.alias("kind"))


def with_edit_distance(pairs: DataFrame, a: str, b: str, edits: int, name: str = "distance") -> DataFrame:
    """Add the edit distance of two string columns where it is at most ``edits`` (at most 15); elsewhere some larger number, or null.

    Bit k of a column's numbers stands for row ``column + k - edits`` of the matrix. ``up`` has the rows that lie one above
    their predecessor, ``down`` those one below. Rows above the first count upwards again and never match; beyond the
    band distances are taken for larger than they are, which leaves all that are within ``edits`` exact.
    """
    width = 2 * edits + 1
    full, low = (1 << width) - 1, (1 << (edits + 1)) - 1
    pad = F.array_repeat(F.lit(""), edits)
    # An element for each row that a column's band can reach; columns of their own, so that they are made once for each pair.
    pairs = pairs.withColumn("_rows", F.concat(pad, F.split(a, ""), F.array_repeat(F.lit(""), 3 * edits + 1)))

    def same(char, column):
        marks = [F.when(F.get("_rows", column + k) == char, 1 << k).otherwise(0) for k in range(width)]
        total = marks[0]
        for mark in marks[1:]:
            total = total + mark
        return total
    pairs = pairs.withColumn("_same", F.transform(F.split(b, ""), same)).drop("_rows")

    def step(s, same):
        up, down = F.shiftright(s["up"], 1).bitwiseOR(1 << (width - 1)), F.shiftright(s["down"], 1)
        x = same.bitwiseOR(down)

        def onward(zero):
            right = F.shiftleft(down.bitwiseOR(full - zero.bitwiseOR(up)), 1).bitwiseOR(1)
            left = F.shiftleft(zero.bitwiseAND(up), 1)
            return F.struct(left.bitwiseOR(F.bitwise_not(zero.bitwiseOR(right))).bitwiseAND(full).alias("up"),
                            zero.bitwiseAND(right).alias("down"),
                            (s["off"] + 1 - F.shiftright(zero, edits).bitwiseAND(1)).alias("off"))
        return _let((x.bitwiseAND(up) + up).bitwiseXOR(up).bitwiseOR(x).bitwiseAND(full), onward)
    n, m = F.char_length(a), F.char_length(b)

    def finish(s):
        # From the cell on the diagonal to the last row, along the last column.
        total = s["off"]
        for k in range(width):
            rise = F.shiftright(s["up"], k).bitwiseAND(1) - F.shiftright(s["down"], k).bitwiseAND(1)
            last = n - m + edits
            total = total + (F.when(F.lit(k) <= last, rise) if k > edits else F.when(F.lit(k) > last, -rise)).otherwise(0)
        return total
    start = F.struct(F.lit(full - low).alias("up"), F.lit(low).alias("down"), F.lit(0).alias("off"))
    found = F.aggregate("_same", start, step, finish)
    found = F.when(F.abs(n - m) <= edits, F.when(n == 0, m).when(m == 0, n).otherwise(found))
    return pairs.withColumn(name, found).drop("_same")


def _let(value, f):
    """Evaluates once what f uses several times."""
    return F.transform(F.array(value), f)[0]


def _steps(a: str, b: str) -> Column:
    """The powers of two up to the length of the shorter string, the largest first."""
    most = F.greatest(F.least(F.char_length(a), F.char_length(b)), F.lit(1)).cast("double")
    return F.transform(F.sequence(F.floor(F.log2(most)).cast("int"), F.lit(0)), lambda k: F.pow(F.lit(2.0), k).cast("int"))


def _common(a: str, b: str, i, j, room, steps: str = "_steps", back: bool = False) -> Column:
    """How many characters agree behind the first i of a and j of b (or before the last ones), at most ``room``.

    Whole strings are compared, in steps that halve, so it takes a dozen comparisons and none by character.
    """
    def step(done, size):
        if back:
            x, y = F.char_length(a) - i - done - size + 1, F.char_length(b) - j - done - size + 1
        else:
            x, y = i + done + 1, j + done + 1
        fits = done + size <= room
        return F.when(fits & (F.substring(a, x, size) == F.substring(b, y, size)), done + size).otherwise(done)
    return F.aggregate(F.col(steps), F.lit(0), step)


def _by_diagonals(a: str, b: str, edits: int) -> Column:
    """The edit distance if it is at most ``edits``, else null: for each number of edits the furthest row on each diagonal."""
    n, m = F.char_length(a), F.char_length(b)
    none = -(1 << 30)
    diagonals = F.array(*[F.lit(d) for d in range(-edits, edits + 1)])

    def along(row, d):
        room = F.least(n - row, m - row - d)
        return F.when((row >= 0) & (row + d >= 0) & (room >= 0), row + _common(a, b, row, row + d, room)).otherwise(none)
    first = F.transform(diagonals, lambda d: F.when(d == 0, along(F.lit(0), F.lit(0))).otherwise(none))

    def arrived(f, e):
        return F.when(F.coalesce(F.get(f, m - n + edits), F.lit(none)) >= n, e)

    def further(s, e):
        def reach(d):
            at = d + edits
            row = F.greatest(F.get(s["f"], at) + 1, F.coalesce(F.get(s["f"], at - 1), F.lit(none)), F.coalesce(F.get(s["f"], at + 1), F.lit(none)) + 1)
            # Beyond the end of either string nothing is left to edit away on this diagonal.
            return _let(F.least(row, n, m - d), lambda r: along(r, d))
        return _let(F.transform(diagonals, reach), lambda f: F.struct(f.alias("f"), F.coalesce(s["found"], arrived(f, e)).alias("found")))
    start = _let(first, lambda f: F.struct(f.alias("f"), arrived(f, F.lit(0)).alias("found")))
    return F.aggregate(F.array(*[F.lit(e) for e in range(1, edits + 1)]).cast("array<int>"), start, further, lambda s: s["found"])


_SHORT = 96  # characters that the bit vectors go through one by one


def with_line_distance(pairs: DataFrame, a: str, b: str, edits: int, name: str = "distance") -> DataFrame:
    """As ``with_edit_distance``, for strings of any length.

    What agrees at the beginning and at the end is cut off by comparing whole strings. The bit vectors go through what is
    left if that is short, as it is between edits that are near each other. Edits that lie far apart leave a long
    part, and the furthest points on the band's diagonals are followed instead, again by comparing whole strings.
    """
    kept = pairs.columns
    pairs = pairs.withColumn("_steps", _steps(a, b)).withColumn("_n", F.least(F.char_length(a), F.char_length(b)))
    pairs = pairs.withColumn("_head", _common(a, b, F.lit(0), F.lit(0), F.col("_n")))
    pairs = pairs.withColumn("_tail", _common(a, b, F.lit(0), F.lit(0), F.col("_n") - F.col("_head"), back=True))
    for side, text in (("_a", a), ("_b", b)):
        pairs = pairs.withColumn(side, F.substring(text, F.col("_head") + 1, F.char_length(text) - F.col("_head") - F.col("_tail")))
    short = F.greatest(F.char_length("_a"), F.char_length("_b")) <= _SHORT
    pairs = pairs.withColumn("_x", F.when(short, F.col("_a")).otherwise("")).withColumn("_y", F.when(short, F.col("_b")).otherwise(""))
    pairs = with_edit_distance(pairs, "_x", "_y", edits, "_bits").withColumn("_steps", _steps("_a", "_b"))
    return pairs.select(*kept, F.when(short, F.col("_bits")).otherwise(_by_diagonals("_a", "_b", edits)).alias(name))


def _distinct(lines: DataFrame) -> DataFrame:
    """Each line once. Copies are reduced before they are exchanged, and every use of the result reads one exchange."""
    return lines.select(line_key("line").alias("id"), "line").groupBy("id").agg(F.max("line").alias("line"))


def _ranked(distinct: DataFrame, edits: int) -> DataFrame:
    """key, kind, id, classes of the lines of every key that some line is listed under and several have, how many ``have`` it, and a ``rank``
    by which those that are listed come first."""
    rows = line_keys(distinct.withColumn("classes", _classes(F.col("line"))), edits)
    whole = Window.partitionBy("key")
    rows = rows.select("*", F.count(F.lit(1)).over(whole).alias("have"), F.min("kind").over(whole).alias("listed"))
    rows = rows.where((F.col("have") > 1) & (F.col("listed") == 0)).drop("listed")  # the order costs more: most keys have one line
    return rows.withColumn("rank", F.row_number().over(_in_key()))


def _in_key() -> Window:
    return Window.partitionBy("key").orderBy("kind", "id")


def _verified(pairs: DataFrame, distinct: DataFrame, edits: int) -> DataFrame:
    """Pairs (u, v, ...) with the ``distance`` of their lines; a line paired with itself has none. Of the latter, those without a ``key``
    have their ``line`` instead.

    Store them before comparing it: the comparison, pushed down into the joins, would compute it over and over.
    """
    kept, pair = pairs.columns, F.col("u") != F.col("v")
    alone = ~pair & (F.col("key").isNull() if "key" in kept else F.lit(True))
    pairs = pairs.join(distinct.select(F.col("id").alias("v"), F.col("line").alias("v_line")), "v")
    pairs = pairs.withColumn("v_line", F.when(pair | alone, F.col("v_line")))  # no text goes along with rows that need none
    pairs = pairs.join(distinct.select(F.col("id").alias("u"), F.col("line").alias("u_line")), "u")
    lines = [F.when(pair, F.col(c)).alias(c) for c in ("u_line", "v_line")]
    pairs = pairs.select(*kept, *lines, F.when(alone, F.col("v_line")).alias("line"))
    return with_line_distance(pairs, "u_line", "v_line", edits).select(*kept, F.when(pair, F.col("distance")).alias("distance"), "line")


def line_components(lines: DataFrame, rules: LineRules, scratch: Scratch) -> DataFrame:
    """``node, component`` of the ids of lines that are connected to others by lines within ``edits`` of each other."""
    both = _paired(lines, rules, scratch)
    scratch.release()  # the exchanges of all lines and keys
    links = both.where(F.col("distance") <= rules.edits).select("u", "v")
    alone = both.where("line IS NOT NULL").select(F.col("u").alias("id"), "line")
    return _connected(links, alone, both.where("key IS NOT NULL").select("key", "kind", F.col("u").alias("id")), rules, scratch)


def _paired(lines: DataFrame, rules: LineRules, scratch: Scratch) -> DataFrame:
    """Pairs (u, v) of short lists' lines with what looks them up, and their ``distance``; what stands in long lists as u = v, with
    ``key`` and ``kind``, and once with its ``line``.

    One query: the lines are exchanged once by id and their keys once by key, and each key's lines are gone through once.
    """
    distinct = _distinct(lines)
    long = F.col("have") > rules.pivots
    # Listed lines come first, so every line of a key finds those in front of it.
    front = F.when((F.col("kind") == 0) & ~long, F.struct("id", "classes"))
    before = _in_key().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = _ranked(distinct, rules.edits).withColumn("front", F.collect_list(front).over(before))  # at most ``pivots``
    met = ranked.where(long | (F.size("front") > 1) | (F.get("front", F.lit(0))["id"] != F.col("id")))
    near = F.filter("front", lambda x: (x["id"] != F.col("id")) & _may_be_near(x["classes"], F.col("classes"), rules.edits))

    def row(u, v, key, kind):
        return F.struct(u.alias("u"), v.alias("v"), key.cast("long").alias("key"), kind.cast("int").alias("kind"))
    none, own = F.lit(None), F.col("id")
    pairs = F.transform(near, lambda x: row(F.least(x["id"], own), F.greatest(x["id"], own), none, none))
    # What stands in a long list, for the rounds to come: its place there, and once the line itself.
    places = F.array(row(own, own, F.col("key"), F.col("kind")), row(own, own, none, none))
    met = met.select(F.explode(F.when(long, places).otherwise(pairs)).alias("r")).select("r.*").distinct()
    return scratch.keep(_verified(met, distinct, rules.edits), "links")


_BAGS = ("etaonihsrdlucm.,", " fpgwybvk0123456", "789xjqz-'\"TAEOSI")  # characters of each number
_BEGINNINGS = (48, 96, 192, 384)  # whose characters of the first number are counted by themselves


_CODES = (0, 1, 3, 7, 15, 14, 12, 8)  # of a number modulo 8: one more or less changes one bit


def _bags(line: Column) -> list[Column]:
    """How often each of many characters occurs, in a line and in its beginnings, modulo 8, sixteen in a number as ``_CODES``: for lines
    of long lists, which are few."""
    codes, found = F.array(*[F.lit(code).cast("long") for code in _CODES]), []
    for text, chars in [(line, c) for c in _BAGS] + [(F.substring(line, 1, n), _BAGS[0]) for n in _BEGINNINGS]:
        total = F.lit(0).cast("long")
        for j, char in enumerate(chars):
            n = F.char_length(text) - F.char_length(F.replace(text, F.lit(char), F.lit("")))
            total = total.bitwiseOR(F.shiftleft(F.get(codes, n % 8), 4 * j))
        found.append(total.alias(f"bag{len(found)}"))
    return found


def _off(a: Column, b: Column) -> Column:
    """How many bits of two bags differ: the sum of the differences of their numbers, as far as these are at most 4."""
    return F.bit_count(a.bitwiseXOR(b))


def _bags_near(a: Column, b: Column, edits: int) -> Column:
    """An edit takes one character away at most, and adds one at most; it also moves one at most out of a beginning, or one into it: as it
    makes it longer or shorter, never both."""
    return _off(a, b) <= 2 * edits


def _connected(links: DataFrame, texts: DataFrame, placed: DataFrame, rules: LineRules, scratch: Scratch) -> DataFrame:
    """``node, component`` of ``links`` and of those that long lists add, until each list lies in one component or has been gone through.

    ``placed`` has a row for each line of each such list, ``texts`` the lines. Two of them whose characters differ by more than ``edits``
    make no row.
    """
    if placed.isEmpty():
        return components(links, scratch, "components")
    bags = [f"bag{i}" for i in range(len(_BAGS) + len(_BEGINNINGS))]
    placed = scratch.keep(placed.join(texts.select("id", *_bags(F.col("line"))), "id"), "placed", few=True)
    seekers = placed.select(F.col("id").alias("s_id"), F.col("key").alias("s_key"), *[F.col(c).alias(f"s_{c}") for c in bags]).distinct()
    left = placed.where("kind = 0").select("key", "id", *bags)
    # A line's bags count different characters: an edit changes two bits of all of them.
    off = [_off(F.col(c), F.col(f"s_{c}")) for c in bags[:len(_BAGS)]]
    near = sum(off[1:], off[0]) <= 2 * rules.edits
    for c in bags[len(_BAGS):]:
        near = near & _bags_near(F.col(c), F.col(f"s_{c}"), rules.edits)
    where, many, turn = None, rules.pivots * 4, 0
    while turn == 0 or not left.isEmpty():
        turn += 1
        if where is None:  # each line by itself: components are found once, of the links so far and those of this turn
            left, asking = (df.withColumn(c, F.col(i)) for df, i, c in ((left, "id", "own"), (seekers, "s_id", "s_own")))
            order = Window.partitionBy("key").orderBy("id")
        else:
            at = where.select(F.col("node").alias("at"), "component")
            left, asking = (df.join(at, F.col(i) == F.col("at"), "left").withColumn(c, F.coalesce("component", i)).drop("at", "component")
                            for df, i, c in ((left, "id", "own"), (seekers, "s_id", "s_own")))
            asking = scratch.keep(asking, f"asking-{turn}", few=True)
            several = asking.groupBy(F.struct("s_key").alias("k")).agg(F.min("s_own").alias("a"), F.max("s_own").alias("b"))
            left = left.join(several.where("a < b").select(F.col("k.s_key").alias("key")), "key", "left_semi")
            # Members of the rarer components first.
            size = left.groupBy(F.struct("key", "own").alias("k")).agg(F.count(F.lit(1)).alias("size"))
            left = left.join(size.select("k.*", "size"), ["key", "own"])
            order = Window.partitionBy("key").orderBy("size", "id")
        left = scratch.keep(left.withColumn("turn", F.row_number().over(order)), f"ranked-{turn}", few=True)
        on = (F.col("key") == F.col("s_key")) & (F.col("own") != F.col("s_own")) & near
        met = left.where(F.col("turn") <= many).join(asking, on).select(F.least("id", "s_id").alias("u"), F.greatest("id", "s_id").alias("v"))
        met = scratch.keep(met.distinct(), f"met-{turn}", few=True)
        found = scratch.keep(_verified(met, texts, rules.edits), f"links-{turn}").where(F.col("distance") <= rules.edits).select("u", "v")
        scratch.release()
        if where is None or not found.isEmpty():
            where = joined(where, links.union(found) if where is None else found, scratch, f"components-{turn}")
        left = scratch.keep(left.where(F.col("turn") > many).select("key", "id", *bags), f"left-{turn}", few=True)
        many *= 8
    return where


def line_classes(docs: DataFrame, rules: LineRules = LineRules(), id_col: str = "doc_id", text_col: str = "text",
                 scratch: Scratch | None = None) -> DataFrame:
    """``doc_id, line_no, n_chars, class_doc, class_line, copies, kept`` of every line that takes part.

    Lines are what ``\\n`` separates, numbered from 0; blank ones and those of rows with a null text or id take no part. Lines of
    fewer than ``least`` characters form classes with their equals (none without ``short``). Equal longer
    lines, and such lines within ``edits`` of each other, directly or through others, form a class, named by its first line
    (smallest document, then smallest number); that one is kept. ``copies`` counts a class's lines. Rows that repeat an id count as one document: lines at the same place in each stand and fall together.
    Other columns do not matter.
    """
    return _classed(docs, rules, id_col, text_col, scratch or Scratch(docs.sparkSession))


def _classed(docs: DataFrame, rules: LineRules, id_col: str, text_col: str, scratch: Scratch, by_text: bool = False) -> DataFrame:
    """As ``line_classes``. ``by_text``: with ``text_key``, the hash of the text that the line stands in."""
    own = ["text_key"] if by_text else []
    lines = occurrences(docs, rules.least, id_col, text_col, rules.short, own).where("doc_id IS NOT NULL")
    compared = lines.where(F.char_length("line") >= rules.least) if rules.short else lines
    where = line_components(compared, rules, scratch)
    every = lines.select("doc_id", *own, "line_no", F.char_length("line").cast("long").alias("n_chars"), line_key("line").alias("id"))
    every = every.join(where, F.col("id") == F.col("node"), "left")
    every = scratch.keep(every.select("doc_id", *own, "line_no", "n_chars", F.coalesce("component", "id").alias("class")), "lines")
    firsts = every.groupBy(F.struct("class").alias("k")).agg(F.min(F.struct("doc_id", "line_no")).alias("first"),
                                                             F.count(F.lit(1)).alias("copies"))
    firsts = firsts.select(F.col("k.class").alias("class"), F.col("first.doc_id").alias("class_doc"), F.col("first.line_no").alias("class_line"), "copies")
    kept = (F.col("doc_id") == F.col("class_doc")) & (F.col("line_no") == F.col("class_line"))
    return every.join(firsts, "class").select("doc_id", *own, "line_no", "n_chars", "class_doc", "class_line", "copies", kept.alias("kept"))


def without_copies(docs: DataFrame, rules: LineRules = LineRules(), scratch: Scratch | None = None) -> DataFrame:
    """``docs`` (doc_id, text, ...) without the lines that ``line_classes`` does not keep.

    Documents of which no line that has a word stays, because all were copies, go; others keep all their columns, and
    n_chars, if they have it, counts the new text. Documents that lose nothing are as they were. Rows that repeat an id
    lose the copies in their own texts only.
    """
    scratch = scratch or Scratch(docs.sparkSession)
    gone = _classed(docs, rules, "doc_id", "text", scratch, by_text=True).where("NOT kept").groupBy("doc_id", "text_key")
    gone = gone.agg(F.collect_set("line_no").alias("gone"))  # at most a document's own lines
    rows = docs.select(F.struct("*").alias("row"))
    rows = rows.join(gone, (F.col("row.doc_id") == F.col("doc_id")) & (F.xxhash64("row.text") == F.col("text_key")), "left")
    text = F.array_join(F.filter(F.split("row.text", "\n", -1), lambda line, i: ~F.array_contains("gone", i)), "\n")
    rows = rows.withColumn("left", F.when(F.col("gone").isNotNull(), text))
    rows = rows.where(F.col("gone").isNull() | F.col("left").rlike(_WORD))
    new = {"text": F.col("left"), "n_chars": F.char_length("left").cast("long")}
    cells = [F.when(F.col("gone").isNotNull(), new[c]).otherwise(F.col(f"row.`{c}`")).alias(c) if c in new else F.col(f"row.`{c}`")
             for c in docs.columns]
    return rows.select(*cells)
