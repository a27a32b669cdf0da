"""Collocations against plain counting."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rosterlift.llm import collocations as co
from rosterlift.llm import queries

DOC = "doc_id long, text string, lang string, hash long, word string, n long, first long"


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def want(rows, least=10, inside=50, first=2000):
    """All result rows, from (lang, text)."""
    counts, total = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", lower(text or "")):
            w = re.findall("[^ \t]+", piece)
            total[lang] += len(w)
            for k in (1, 2, 3):
                counts[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, f in counts.items():
        good = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        longer = {}
        for p, a in good.items():
            for q in (p[:2], p[1:]) if len(p) == 3 else ():
                longer[q] = max(longer.get(q, 0), a)
        scored = []
        for p, a in good.items():
            if len(p) == 2 and 100 * longer.get(p, 0) >= inside * a and p in longer:
                continue
            score, k = min((10**6 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, left, right, total[lang], -s) for i, (s, a, p, left, right) in enumerate(sorted(scored)[:first])]
    return sorted(out)


def rows_of(df):
    return sorted((r.lang, r.rank, r.phrase, r.a, r.l, r.r, r.n, r.score) for r in df.collect())


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 4), st.integers(0, 3), st.integers(0, 3), st.integers(1, 6)), max_size=40), st.integers(1, 8))
def test_quicksort_counts(suffixes, least):
    suffixes = [(a, b, c if b else 0, n) for a, b, c, n in suffixes]
    keys = [np.array([s[i] for s in suffixes], np.uint64) for i in range(3)]
    weight = np.array([s[3] for s in suffixes], np.int64)
    got = {}
    for depth, at, counts in co.multikey_quicksort(keys, weight, least):
        for p, n in zip(at.tolist(), counts.tolist()):
            phrase = suffixes[p][:depth]
            assert phrase not in got
            got[phrase] = n
    plain = Counter()
    for a, b, c, n in suffixes:
        if b:
            plain[a, b] += n
        if c:
            plain[a, b, c] += n
    assert got == {p: n for p, n in plain.items() if n >= least}


def test_packed_suffixes_come_back():
    rng = np.random.default_rng(3)
    rows = np.unique(rng.integers(0, 9, (500, 3), np.uint64) << np.uint64(60), axis=0)
    weight = rng.integers(1, 100, len(rows))
    back = co.unpacked_suffixes(co.packed_suffixes(*rows.T, weight))
    assert all((a == b).all() for a, b in zip(back, (*rows.T, weight)))


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_whole_table(spark, folder):
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("lang", "text").collect()
    assert rows_of(queries.op13_collocations(spark, folder)) == want(rows)


ODD = [(None, None), ("en", None), ("en", ""), (None, "a b c\x0ba b.c"), ("", "x y z"), ("en", "ÀB àb ÀB"), ("de", "w" * 300_000 + " q q")]


@pytest.mark.parametrize("group_bytes,common", [(1 << 30, 1.0), (2000, 1.0), (2000, 1 / 100)])
def test_groups_and_common_leading_words_change_nothing(spark, monkeypatch, group_bytes, common):
    monkeypatch.setattr(co, "_BLOB", 50)
    rng = random.Random(5)
    rows = ODD + [(rng.choice(["en", "de", None]), " ".join(rng.choice(["The the", "of", "the of", f"w{rng.randrange(30)}", "x, y", "q!\t"])
                                                          for _ in range(rng.randrange(80)))) for _ in range(300)]
    rows += [("en", f"hot pair w{i}") for i in range(400)] + [("en", f"hot pair w{i % 30} end") for i in range(400)]
    table = spark.createDataFrame([(1, t, g, 1, "w", 2, 3) for g, t in rows], DOC).repartition(4)
    options = co.Collocations(least=3, first=50, group_bytes=group_bytes, common=common)
    assert rows_of(co.collocations(table, options)) == want(rows, 3, first=50)
    if common < 1:
        texts = table.selectExpr("coalesce(lang, 'und') AS lang", "coalesce(text, '') AS text")
        assert len(co._common_pairs(texts, options))


def test_one_text_longer_than_a_slice(spark, monkeypatch):
    rng = random.Random(1)
    text = " ".join(f"w{int(rng.paretovariate(0.7)) % 500}" + "." * (rng.random() < 0.1) for _ in range(5000))
    monkeypatch.setattr(co, "_SLICE", 700)
    table = spark.createDataFrame([(1, text, "en", 1, "w", 2, 3)], DOC)
    batches = table.select("lang", "text").toArrow().to_batches()
    assert [n for _, n in co._Reader().slices(iter(batches))] == [700] * 7 + [100]
    assert rows_of(co.collocations(table)) == want([("en", text)])


def test_scores_are_exact_beyond_64_bits(spark):
    rng = random.Random(9)
    cases = [(a := rng.randrange(1, 10**rng.randrange(1, 13)), a + rng.randrange(10**rng.randrange(1, 13)), a + rng.randrange(10**rng.randrange(1, 13)))
             for _ in range(300)]
    got = spark.createDataFrame(cases, "a long, l long, r long").select("*", co._score("a", "l", "r").alias("s")).collect()
    assert all(r.s == 10**6 * r.a * r.a // (r.l * r.r) for r in got)


def test_empty_table(spark):
    assert co.collocations(spark.createDataFrame([], DOC)).count() == 0
