"""Secret scans: known forms by pattern, and strings that look random by a battery of tests. SQL functions only.

A candidate is a long run of characters that encodings use. Its encoding is inferred from the characters it has: hex,
base 32 or base 64. Three tests ask whether it may be a uniform draw from that alphabet: chi-squared on the counts of its
symbols, the number of runs above and below the middle of the alphabet, and the serial correlation of neighbours. Fisher's
rule joins their p-values, each at most exp(-z^2 / 2); a string whose joint one is below ``level`` is no random one.

Passing says little about a short string, so discoveries are controlled. Under the hypothesis that a string is ordinary
writing, equal symbols meet in a share ``repeats`` of its pairs of places; the bound exp(-z^2 / 2) on how few do is its
p-value; of strings in hex, digits and letters mixed, it is how seldom writing keeps to so few letters. Short strings have too
few pairs for that, but they mix small letters, capitals and digits: the ratio of their likelihoods, as written and as
drawn, from neighbour to neighbour, is at most so often that small in writing. How writing goes on from class to class is
counted in all candidates of the table that repeat symbols as writing does, and starts from a fixed table; a ratio counts
only as far as it holds against both. Fisher's rule joins it with the repeats, and the smaller p-value counts; a normal
tail is at most half of the bound, which pays for the choice. Strings of like length form a stratum, and in each the
Benjamini-Hochberg rule at ``discovery_rate`` over all its candidates sets the p-value up to which they are reported. The
rule needs counts by stratum and p-value class only, so nothing is sorted or gathered; 32 counts go to the driver.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._store import Scratch

#: Kinds in the order in which spans that begin together are listed.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
_CLASSES = 400  # of p-values, by -log10 in twentieths
#: How ordinary writing, with names like someName, some-name and some_2, goes on after a small letter, capital, digit, sign.
_WRITTEN = ((0.80, 0.08, 0.04, 0.08), (0.50, 0.40, 0.04, 0.06), (0.05, 0.05, 0.75, 0.15), (0.55, 0.20, 0.20, 0.05))
_CAPITALS = ((1, 1, 1, 1), (1, 0.93, 0.07, 1), (1, 0.25, 0.75, 1), (1, 1, 1, 1))  # all in capitals and digits


@dataclass(frozen=True)
class RandomnessTests:
    least: int = 20  # characters of a candidate
    level: float = 0.001  # joint p-value of the three tests below which a string is not taken for a draw
    repeats: float = 0.065  # share of pairs of places with equal letters in ordinary writing
    hex_letters: float = 0.3  # share of letters that hex has too in ordinary writing
    prior: float = 100.0  # neighbours, after each class, that the fixed table of writing is worth beside those counted
    discovery_rate: float = 0.01
    strata: tuple[int, ...] = (20, 24, 32, 48, 64, 128)  # lengths at which strata begin


def _found(text: Column, pattern: str, keep) -> Column:
    """Start and end, in characters, of the leftmost non-overlapping matches for which ``keep`` of (match, groups) holds.

    The text between the matches gives their places: it is what splitting at them leaves.
    """
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    pairs = F.zip_with(gaps, whole, lambda gap, match: F.struct(F.length(gap).alias("gap"), match.alias("match")))
    empty = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int,match:string>>").alias("spans"))

    def step(state, pair):
        start = state["at"] + pair["gap"]
        end = start + F.coalesce(F.length(pair["match"]), F.lit(0))
        span = F.array(F.struct(start.alias("start"), end.alias("end"), pair["match"].alias("match")))
        spans = F.when(pair["match"].isNotNull() & keep(pair["match"]), F.concat(state["spans"], span)).otherwise(state["spans"])
        return F.struct(end.alias("at"), spans.alias("spans"))
    return F.aggregate(pairs, empty, step, lambda state: state["spans"])


def _if_any(text: Column, test: str, found: Column) -> Column:
    return F.when(text.rlike(test), found).otherwise(F.array().cast("array<struct<start:int,end:int,match:string>>"))


def _base(text: Column) -> list[Column]:
    value = lambda m: F.length(F.regexp_extract(m, ASSIGN, 1)) >= 8
    return [_if_any(text, r"(?i:passw|secret|token|api_?key)", _found(text, ASSIGN, value)).alias("assign"),
            _if_any(text, r"AKIA[A-Z0-9]{12}", _found(text, ACCESS, lambda m: F.length(m) >= 16)).alias("access"),
            # Runs of 32 and more: shorter runs end where they end, so they need not be matched and dropped.
            _if_any(text, r"[0-9a-f]{32}", _found(text, HEX[:-1] + "{32,}", lambda m: F.lit(True))).alias("hex")]


def _statistics(p: RandomnessTests) -> dict[str, Column]:
    """Of a candidate ``match``: each test's deviation, and the deviation of its repeats from ordinary writing."""
    base = F.when(F.col("match").rlike("^([0-9a-f]+|[0-9A-F]+)$"), F.lit(16)).when(F.col("match").rlike("^[A-Z2-7]+$"), F.lit(32)).otherwise(F.lit(64))
    signs = F.when(F.col("size") == 16, F.lit("0123456789abcdef")).when(F.col("size") == 32, F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")) \
        .otherwise(F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"))
    text = F.when(F.col("size") == 16, F.lower("match")).otherwise(F.translate("match", "-_", "+/"))
    n = F.col("n").cast("double")
    middle = (F.col("size") - 1) / 2.0
    squares = F.aggregate(F.array_distinct("signs"), F.lit(0.0), lambda sum_, sign: sum_ + F.pow(
        F.size(F.filter("signs", lambda x: x == sign)).cast("double"), F.lit(2.0)))
    neighbours = F.zip_with(F.slice("codes", F.lit(1), F.col("n") - 1), F.slice("codes", F.lit(2), F.col("n") - 1),
                            lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    changes = F.aggregate("neighbours", F.lit(0.0), lambda s, x: s + F.when((x["a"] > middle) != (x["b"] > middle), 1.0).otherwise(0.0))
    products = F.aggregate("neighbours", F.lit(0.0), lambda s, x: s + (x["a"] - middle) * (x["b"] - middle))
    variance = (F.pow(F.col("size").cast("double"), F.lit(2.0)) - 1) / 12
    pairs = n * (n - 1) / 2
    spelt = F.col("match").rlike("[0-9]") & F.col("match").rlike("[A-Fa-f]")
    return {
        "size": base, "n": F.length("match"), "signs": F.split(text, ""),
        "codes": F.transform("signs", lambda x: (F.instr(signs, x) - 1).cast("double")), "neighbours": neighbours,
        "squares": squares,
        "uniform": (F.col("squares") * F.col("size") / n - n - (F.col("size") - 1)) / F.sqrt(2.0 * (F.col("size") - 1)),
        "runs": (changes - (n - 1) / 2) / F.sqrt((n - 1) / 4),
        "serial": products / (variance * F.sqrt(n - 1)),
        "excess": F.when(F.col("size") == 16, F.when(spelt, F.sqrt(2 * n * F.log(F.lit(1 / p.hex_letters)))).otherwise(0.0)).otherwise(
            (pairs * p.repeats - (F.col("squares") - n) / 2) / F.sqrt(pairs * p.repeats * (1 - p.repeats)))}


def _uniform_draw() -> Column:
    """The joint p-value of the three tests, by Fisher's rule for three."""
    x = (F.col("uniform") * F.col("uniform") + F.col("runs") * F.col("runs") + F.col("serial") * F.col("serial")) / 2
    return F.exp(-x) * (1 + x + x * x / 2)


def _steps() -> Column:
    """The classes of a candidate's neighbours: class * 4 + next class; small letter, capital, digit, sign."""
    classes = F.transform("signs", lambda c: F.when(c.between("a", "z"), 0).when(c.between("A", "Z"), 1).when(c.between("0", "9"), 2).otherwise(3))
    return F.zip_with(F.slice(classes, F.lit(1), F.col("n") - 1), F.slice(classes, F.lit(2), F.col("n") - 1), lambda a, b: a * 4 + b)


def _facts(candidates: DataFrame, p: RandomnessTests) -> DataFrame:
    """Of every candidate what the rules need to know."""
    for name, column in _statistics(p).items():
        candidates = candidates.withColumn(name, column)
    steps = F.when(F.col("size") > 16, _steps()).otherwise(F.array().cast("array<int>"))
    return candidates.select("row", "start", "end", "size", "n", "excess", (_uniform_draw() >= p.level).alias("passes"), steps.alias("steps"))


def _counted(facts: DataFrame, p: RandomnessTests) -> dict[int, list[list[float]]]:
    """By alphabet, how writing goes on from class to class in this table: candidates that repeat symbols as writing does."""
    seen = {(r["size"], r["step"]): r["times"] for r in facts.where("excess <= 1").select("size", F.explode("steps").alias("step"))
            .groupBy("size", "step").agg(F.count(F.lit(1)).alias("times")).collect()}  # 32 rows at most
    out = {}
    for size, fixed in ((32, _CAPITALS), (64, _WRITTEN)):
        rows = [[seen.get((size, 4 * i + j), 0) for j in range(4)] for i in range(4)]
        out[size] = [[(n + p.prior * f) / (sum(row) + p.prior) for n, f in zip(row, of, strict=True)] for row, of in zip(rows, fixed, strict=True)]
    return out


def _likelier(written, drawn: tuple) -> Column:
    """How much likelier, by logarithm, a candidate's neighbours are in a draw than in writing."""
    table = F.array(*[F.lit(math.log(n / of) if n else 0.0) for row in written for of, n in zip(row, drawn, strict=True)])
    return F.aggregate("steps", F.lit(0.0), lambda s, x: s + F.get(table, x))


def _tested(facts: DataFrame, p: RandomnessTests) -> DataFrame:
    """Candidates with ``stratum``, ``passes`` and the class of their p-value; 0 is the class of p-value 1."""
    counted = _counted(facts, p)
    mixed = F.lit(0.0)
    for size, fixed, drawn in ((32, _CAPITALS, (0, 26 / 32, 6 / 32, 0)), (64, _WRITTEN, (26 / 64, 26 / 64, 10 / 64, 2 / 64))):
        mixed = F.when(F.col("size") == size, F.least(_likelier(fixed, drawn), _likelier(counted[size], drawn))).otherwise(mixed)
    stratum = F.lit(0)
    for at in p.strata[1:]:
        stratum = stratum + F.when(F.col("n") >= at, 1).otherwise(0)
    facts = facts.withColumn("repeated", F.when(F.col("excess") > 0, F.col("excess") * F.col("excess") / 2).otherwise(0.0))
    facts = facts.withColumn("both", F.col("repeated") + F.greatest(mixed, F.lit(0.0)))
    weight = F.greatest(F.col("repeated"), F.col("both") - F.log(1 + F.col("both"))) / math.log(10)
    return facts.select("row", "start", "end", stratum.alias("stratum"), "passes",
                        F.least(F.floor(weight * 20), F.lit(_CLASSES)).cast("int").alias("p_class"))


def _limits(tested: DataFrame, p: RandomnessTests) -> DataFrame:
    """Per stratum the smallest class that the Benjamini-Hochberg rule lets through; at most a row for each stratum."""
    # Only strings that pass the battery can be discoveries; all candidates count as tests.
    counts = tested.groupBy("stratum", "p_class").agg(F.count(F.lit(1)).alias("tests"), F.count_if("passes").alias("n"))
    upward = Window.partitionBy("stratum").orderBy(F.desc("p_class"))  # _CLASSES rows at most
    counts = counts.withColumn("rank", F.sum("n").over(upward)).withColumn("all", F.sum("tests").over(Window.partitionBy("stratum")))
    largest = F.pow(F.lit(10.0), -F.col("p_class") / 20.0)
    return counts.where(largest <= p.discovery_rate * F.col("rank") / F.col("all")).groupBy("stratum").agg(F.min("p_class").alias("limit"))


def _scanned(docs: DataFrame, p: RandomnessTests, id_col: str, text_col: str, scratch: Scratch | None) -> DataFrame:
    """Each row's id, the hash of its text and its spans of every kind."""
    scratch = scratch or Scratch(docs.sparkSession)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    run = "[A-Za-z0-9+/_-]{%d" % p.least
    candidates = _if_any(F.col("text"), run + "}", _found(F.col("text"), run + ",}", lambda m: F.lit(True)))
    rows = rows.select("doc_id", F.xxhash64("text").alias("text_key"), *_base(F.col("text")), candidates.alias("candidates"))
    rows = scratch.keep(rows.withColumn("row", F.monotonically_increasing_id()), "scanned")
    touched = lambda c: F.exists(F.concat("assign", "access", "hex"), lambda s: (s["start"] < c["end"]) & (c["start"] < s["end"]))
    candidates = rows.select("row", F.explode(F.filter("candidates", lambda c: ~touched(c))).alias("c")).select("row", "c.start", "c.end", "c.match")
    tested = _tested(scratch.keep(_facts(candidates, p), "facts"), p)
    # A row for each stratum.
    found = tested.join(F.broadcast(_limits(tested, p)), "stratum").where(F.col("passes") & (F.col("p_class") >= F.col("limit")))
    found = found.groupBy(F.col("row").alias("of")).agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("random"))
    plain = lambda name: F.transform(name, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))).alias(name)
    none = F.array().cast("array<struct<start:int,end:int>>")
    return rows.join(found, F.col("row") == F.col("of"), "left").select(
        "doc_id", "text_key", plain("assign"), plain("access"), plain("hex"), F.coalesce("random", none).alias("random"))


def secret_spans(docs: DataFrame, p: RandomnessTests = RandomnessTests(), id_col: str = "doc_id", text_col: str = "text",
                 scratch: Scratch | None = None) -> DataFrame:
    """``doc_id, assign, access, hex, random`` of every row: each kind's spans, ``array<struct<start,end>>``, in code points.

    The first three are all matches of their patterns, whatever the tests say; ``random`` are the discoveries that touch
    none of them. Null and empty texts have none. Rows are scanned one by one: null or repeated ids and other columns
    do not matter.
    """
    return _scanned(docs, p, id_col, text_col, scratch).drop("text_key")


def listed(kinds: tuple[str, ...]) -> Column:
    """The spans of some kinds as text: kind:start:end, by start, then kind as listed, comma-joined."""
    def spans(order: int, kind: str) -> Column:
        return F.transform(kind, lambda s: F.struct(s["start"].alias("start"), F.lit(order).alias("order"), s["end"].alias("end")))
    parts = [spans(KINDS.index(k), k) for k in kinds]
    name = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(F.sort_array(F.concat(*parts)), lambda s: F.concat_ws(":", name[s["order"]], s["start"], s["end"])), ",")



def masked(docs: DataFrame, p: RandomnessTests = RandomnessTests(), mark: str = "[secret]", scratch: Scratch | None = None) -> DataFrame:
    """``docs`` (doc_id, text, ...) with ``mark`` in place of every span found in the text; spans that touch make one.

    All columns stay, whatever they are called; n_chars, if there is one, counts the new text. Rows without spans are as
    they were; rows that repeat an id are masked by their own texts.
    """
    found = _scanned(docs, p, "doc_id", "text", scratch)
    spans = F.sort_array(F.concat(*KINDS))
    found = found.select("doc_id", "text_key", spans.alias("spans")).where(F.size("spans") > 0)
    found = found.groupBy("doc_id", "text_key").agg(F.first("spans").alias("spans"))  # rows of equal texts have equal spans
    rows = docs.select(F.struct("*").alias("row"))
    rows = rows.join(found, F.col("row.doc_id").eqNullSafe(F.col("doc_id")) & (F.xxhash64("row.text") == F.col("text_key")), "left")
    text = F.col("row.text")

    def step(state, span):
        before = F.substring(text, state["at"] + 1, F.greatest(span["start"] - state["at"], F.lit(0)))
        joined = F.when((span["start"] <= state["at"]) & (state["at"] > 0), state["out"]).otherwise(F.concat(state["out"], before, F.lit(mark)))
        return F.struct(F.greatest(span["end"], state["at"]).alias("at"), joined.alias("out"))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    new = F.aggregate("spans", start, step, lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.char_length(text))))
    rows = rows.withColumn("masked", F.when(F.col("spans").isNotNull(), new))
    put = {"text": F.col("masked"), "n_chars": F.char_length("masked").cast("long")}
    cells = [F.when(F.col("spans").isNotNull(), put[c]).otherwise(F.col(f"row.`{c}`")).alias(c) if c in put else F.col(f"row.`{c}`")
             for c in docs.columns]
    return rows.select(*cells)
