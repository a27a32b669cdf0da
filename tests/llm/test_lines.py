"""Line dedup against all pairs, and the bit-parallel distance against Spark's own."""

import random
import string

import pytest
from pyspark.sql import functions as F

from rosterlift.llm import lines as module
from rosterlift.llm import queries
from rosterlift.llm.lines import LineRules, line_classes, with_edit_distance, with_line_distance, without_copies


def within(a, b, k):
    if abs(len(a) - len(b)) > k:
        return False
    above = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i] + [k + 1] * len(b)
        for j in range(max(1, i - k), min(len(b), i + k) + 1):
            row[j] = min(above[j] + 1, row[j - 1] + 1, above[j - 1] + (x != b[j - 1]))
        above = row
        if min(above[max(0, i - k):i + k + 1]) > k:
            return False
    return above[len(b)] <= k


def brute(rows, edits, least, short=True):
    places, few = {}, {}
    for i, text in rows:
        for n, line in enumerate((text or "").split("\n") if text is not None else []):
            if len(line) >= least or short and line.strip(" \t\n\x0b\x0c\r"):
                (places if len(line) >= least else few).setdefault(line, set()).add((i, n))
    lines = sorted(places)
    root = list(range(len(lines)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    letters = [{c: line.count(c) for c in set(line)} for line in lines]
    for a in range(len(lines)):
        for b in range(a):
            if abs(len(lines[a]) - len(lines[b])) <= edits and find(a) != find(b):
                x, y = letters[a], letters[b]
                if sum(abs(x.get(c, 0) - y.get(c, 0)) for c in {*x, *y}) <= 2 * edits and within(lines[a], lines[b], edits):
                    root[find(a)] = find(b)
    groups = {}
    for k, line in enumerate(lines):
        groups.setdefault(find(k), []).extend(places[line])
    return {p: (min(g), p == min(g)) for g in [*groups.values(), *few.values()] for p in g}


def got(df):
    return {(r.doc_id, r.line_no): ((r.class_doc, r.class_line), r.kept) for r in df.collect()}


def test_whole_table(spark, small):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    assert got(queries.op10_line_dedup(spark, small)) == brute(rows, 2, 20)


@pytest.mark.parametrize(("edits", "pivots"), [(1, 16), (2, 1), (2, 16), (3, 4)])
def test_chains_templates_and_common_segments(docs, edits, pivots):
    rng = random.Random(edits * 10 + pivots)
    lines = [f"Order number {rng.randrange(10**6):06} was sent" for _ in range(120)]  # one template, mostly further apart
    for _ in range(8):
        line = "".join(rng.choice("abcdefé ") for _ in range(rng.randrange(8, 50)))
        for _ in range(15):
            lines.append(line)
            at = rng.randrange(len(line) + 1)
            line = rng.choice([line[:at] + "é" + line[at:], line[:at] + line[at + 1:], line[:at] + "z" + line[at + 1:]])
    lines += ["the same line in many places"] * 60 + ["short", "", " " * 12, "\t" * 12]
    rng.shuffle(lines)
    rows = [(i, "\n".join(lines[i * 6:i * 6 + 6])) for i in range(len(lines) // 6)] + [(900, None), (901, "")]
    assert got(line_classes(docs(rows), LineRules(edits, 8, pivots))) == brute(rows, edits, 8)


@pytest.mark.parametrize(("distance", "short"), [(with_edit_distance, 96), (with_line_distance, 96), (with_line_distance, 4), (with_line_distance, -1)])
def test_distance(spark, monkeypatch, distance, short):
    monkeypatch.setattr(module, "_SHORT", short)
    rng = random.Random(1)
    pairs = []
    for _ in range(1500):
        a = "".join(rng.choice("abé") for _ in range(rng.choice([0, 1, 2, 3, 5, 9, 40])))
        b = list(a)
        for _ in range(rng.randrange(5)):
            at = rng.randrange(len(b) + 1)
            b[at:at + rng.randrange(2)] = rng.choice(["", "c", "a"])
        pairs.append((a, "".join(b)))
    df = spark.createDataFrame(pairs, "a string, b string").withColumn("true", F.levenshtein("a", "b"))
    for edits in (0, 1, 2, 3, 7):
        for r in distance(df, "a", "b", edits).collect():
            near = r.distance is not None and r.distance <= edits
            assert near == (r.true <= edits) and (not near or r.distance == r.true), (r, edits)


def test_variants_of_one_line_are_told_apart_before_they_are_paired(docs, monkeypatch):
    rng = random.Random(11)
    letters, common = "oihrsdluvw", "the same beginning of a line that goes on with "  # letters that the first comparison does not count
    lines = [common + "".join(rng.choice(letters) for _ in range(30)) for _ in range(240)]
    lines += [line[:-1] + "z" for line in lines[:20]]
    rows = [(i, line) for i, line in enumerate(lines)]
    made, verified = [], module._verified

    def counted(pairs, distinct, edits):
        made.append(pairs.where("u <> v").count())
        return verified(pairs, distinct, edits)
    monkeypatch.setattr(module, "_verified", counted)
    assert got(line_classes(docs(rows), LineRules(pivots=2))) == brute(rows, 2, 20)
    assert len(made) > 1 and sum(made[1:]) < 400  # of some 33,000 pairs


def test_a_long_list_pairs_no_lines_before_all_their_characters_are_compared(docs, monkeypatch):
    rng = random.Random(12)
    letters, common = "oihrsdluvw", "the same beginning of a line that goes on with "
    lines = [common + "".join(rng.choice(letters) for _ in range(30)) for _ in range(240)]
    lines += [line[:-1] + "z" for line in lines[:20]]
    rows = [(i, line) for i, line in enumerate(lines)]
    made, verified = [], module._verified

    def counted(pairs, distinct, edits):
        made.append(pairs.where("u <> v").count())
        return verified(pairs, distinct, edits)
    monkeypatch.setattr(module, "_verified", counted)
    assert got(line_classes(docs(rows))) == brute(rows, 2, 20)
    assert 20 <= sum(made) < 400  # sixteen of them, paired with all, would make some 4,000


def test_one_character_more_or_less_changes_one_bit():
    codes = module._CODES
    for n, code in enumerate(codes):
        for m, other in enumerate(codes):
            assert (code ^ other).bit_count() == min((n - m) % 8, (m - n) % 8)


@pytest.mark.parametrize("edits", [1, 2, 4])
def test_lines_within_the_edits_pass_the_comparison_of_characters(spark, edits):
    rng = random.Random(edits)
    alphabet, pairs = "".join(module._BAGS) + "é漢𝄞", []
    for n in [3, 47, 48, 49, 95, 97, 191, 193, 400] * 20:
        a = "".join(rng.choice(alphabet[:rng.choice([2, 20, len(alphabet)])]) for _ in range(n))
        b = list(a)
        for _ in range(edits):
            at = rng.randrange(len(b) + 1)
            b[at:at + rng.randrange(2)] = rng.choice(["", "e", "é", "7"])
        pairs.append((a, "".join(b)))
    pairs.append(("rain on the road", "sun over the sea"))
    df = spark.createDataFrame(pairs, "a string, b string").select("a", F.levenshtein("a", "b").alias("distance"), *[
        bag.alias(f"{side}{i}") for side in ("a", "b") for i, bag in enumerate(module._bags(F.col(side)))]).localCheckpoint()
    near = F.lit(True)
    for i in range(len(module._BAGS) + len(module._BEGINNINGS)):
        near = near & module._bags_near(F.col(f"a{i}"), F.col(f"b{i}"), edits)
    passed = df.select("a", "distance", near.alias("near")).collect()
    assert all(r.near for r in passed if r.distance <= edits) and not passed[-1].near


def test_very_long_lines_and_empty_tables(docs):
    rng = random.Random(3)
    line = "".join(rng.choice(string.ascii_lowercase + " ") for _ in range(30_000))
    other = line[:100] + "X" + line[100:29_000] + line[29_001:]
    rows = [(1, line), (2, other), (3, line + "abc"), (4, line[::-1])]
    assert got(line_classes(docs(rows))) == brute(rows, 2, 20)
    assert line_classes(docs([])).collect() == []
    assert without_copies(docs([])).collect() == []


def test_short_lines_as_exact_copies(docs):
    one, near = "a line that is long enough", "a line that is long enough!"
    rows = [(1, f"Les.\n{one}\nOf, edti oner.\n\n  "), (2, f"Les.\n{near}\nLes!\n\n  "), (3, "Of, edti oner.\nLes."), (4, None), (None, "Les.")]
    found = got(line_classes(docs(rows)))
    assert found == {(1, 0): ((1, 0), True), (1, 1): ((1, 1), True), (1, 2): ((1, 2), True), (2, 0): ((1, 0), False), (2, 1): ((1, 1), False),
                     (2, 2): ((2, 2), True), (3, 0): ((1, 2), False), (3, 1): ((1, 0), False)}
    assert {r.doc_id: r.text for r in without_copies(docs(rows)).collect()} == {1: rows[0][1], 2: "Les!\n\n  ", 4: None, None: "Les."}


def test_stage_keeps_what_another_row_of_the_id_lost(docs):
    one, two, three = "a line that is long enough", "another line that is long enough", "nothing like what stands elsewhere"
    rows = [(1, one), (2, f"{one}\n{two}"), (2, f"{three}\nshort"), (2, f"{three}\nshort")]
    left = without_copies(docs(rows), LineRules(short=False))
    assert sorted((r.doc_id, r.text) for r in left.collect()) == [(1, one), (2, two), *[(2, f"{three}\nshort")] * 2]


def test_stage_keeps_columns_and_drops_whole_copies(spark):
    one, two = "a line that is long enough", "another line that is long enough"
    rows = spark.createDataFrame([(1, f"{one}\nshort\n{two}", 65, "x"), (2, f"{one}\nshort", 32, "y"), (3, f"{two}!\n  ", 36, "z"), (4, None, None, "n"),
                                  (None, one, 26, "m"), (5, "", 0, "e")], "doc_id long, text string, n_chars long, gone string")
    left = without_copies(rows, LineRules(short=False))
    assert left.columns == rows.columns
    assert sorted((tuple(r) for r in left.collect()), key=str) == sorted(
        [(1, f"{one}\nshort\n{two}", 65, "x"), (2, "short", 5, "y"), (4, None, None, "n"), (None, one, 26, "m"), (5, "", 0, "e")], key=str)
