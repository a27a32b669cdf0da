"""Near-duplicates against all pairs of shingle sets."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rosterlift.llm import minhash as module
from rosterlift.llm import queries
from rosterlift.llm._store import Scratch
from rosterlift.llm._text import chunks, lower, shingle_hashes, span_hashes, words
from rosterlift.llm.minhash import NearDuplicates, near_duplicates, one_of_each


def shingles(text, size):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))) if w else frozenset()


def brute(rows, size, percent=80):
    sets = [(i, shingles(t, size)) for i, t in rows]
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, (i, s) in enumerate(sets):
        for j, t in sets[:a]:
            if s and t and 100 * len(s & t) >= percent * len(s | t):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i: (len(s), find(i), find(i) == i) for i, s in sets}


def found(df):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in df.collect()}


def writing(rng, n, vocabulary=2000):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def test_whole_table(spark, small):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    assert found(queries.op1_minhash_near_dedup(spark, small)) == brute(rows, 4)


@pytest.mark.parametrize("pivots", [1, 16])
def test_edited_copies_chains_and_shared_passages(docs, pivots):
    rng = random.Random(5)
    rows, passage = [], writing(rng, 60)
    for _ in range(6):  # groups of copies, each a few words away from the last: links chain
        text = writing(rng, 150)
        for _ in range(12):
            rows.append(" ".join(text))
            for _ in range(rng.randrange(4)):
                text = list(text)
                text[rng.randrange(len(text))] = f"x{rng.random()}"
    rows += [" ".join(passage + writing(rng, rng.randrange(8, 40))) for _ in range(40)]  # linked, or only quoting
    rows += ["", None, " \t\n", "one", "One", "two words", "two  WORDS", "a b c", "a b c d"]
    rows = list(enumerate(rows, 3))
    rng.shuffle(rows)
    assert found(near_duplicates(docs(rows), NearDuplicates(shingle=3, pivots=pivots))) == brute(rows, 3)


def test_a_pair_makes_a_row_in_one_of_its_lists(docs, monkeypatch):
    rng = random.Random(7)
    text, made, met = writing(rng, 200), [], module._met

    def counted(*args):
        pairs = met(*args)
        made.append((pairs.count(), pairs.distinct().count()))
        return pairs
    monkeypatch.setattr(module, "_met", counted)
    rows = []
    for i in range(80):  # near copies: each two share most of their lists
        words = list(text)
        for _ in range(3):
            words[rng.randrange(200)] = f"x{rng.randrange(40)}"
        rows.append((i, " ".join(words)))
    assert found(near_duplicates(docs(rows), NearDuplicates(shingle=3))) == brute(rows, 3)
    rows, pairs = map(sum, zip(*made, strict=True))
    assert pairs > 100 and rows <= 2 * pairs, made


def test_many_copies_and_ties(docs):
    rows = [(i, "the same text over and over again") for i in range(300)] + [(1000 + i, f"text number {i}") for i in range(50)]
    assert found(near_duplicates(docs(rows))) == brute(rows, 5)


def test_empty_tables_nulls_and_repeated_rows(docs):
    assert near_duplicates(docs([])).collect() == []
    got = near_duplicates(docs([(None, "a b c d e f"), (1, "a b c d e f"), (2, "A b c d e f"), (2, "A b c d e f"), (3, None)])).collect()
    assert sorted(((r.doc_id or 0, r.n_shingles, r.component_id, r.kept) for r in got), key=str) == sorted(
        [(0, 2, None, True), (1, 2, 1, True), (2, 2, 1, False), (2, 2, 1, False), (3, 0, 3, True)], key=str)


def test_only_component_steps_are_written_in_few_tasks(docs, monkeypatch):
    few, keep = {}, Scratch.keep

    def noted(self, df, name, few_=False, **kw):
        few[name.split("-")[0]] = kw.get("few", few_)
        return keep(self, df, name, kw.get("few", few_))
    monkeypatch.setattr(Scratch, "keep", noted)
    text = " ".join(f"w{i}" for i in range(60))
    near_duplicates(docs([(1, text), (2, text + " more"), (3, "other words altogether here")])).collect()
    assert {"classes", "lists", "sets", "pairs", "links", "components"} <= set(few)
    assert {name for name, small in few.items() if small} <= {"components"}


def test_stage_keeps_one_row_of_each_and_all_columns(spark):
    rows = spark.createDataFrame([(1, "a b c d e f", 7, "x"), (1, "a b c d e f", 7, "x"), (1, "", 1, "z"), (2, "a b c d e f", 8, "y"),
                                  (None, "a b c d e f", 9, "n"), (5, None, 3, None)], "doc_id long, text string, class int, kept string")
    left = one_of_each(rows)
    assert left.columns == rows.columns
    assert sorted((tuple(r) for r in left.collect()), key=str) == [
        (1, "", 1, "z"), (1, "a b c d e f", 7, "x"), (5, None, 3, None), (None, "a b c d e f", 9, "n")]


def test_unlike_texts_of_one_id_all_stay(spark):
    rows = [(1, "alpha beta gamma delta epsilon zeta"), (1, "one two three four five six"), (3, "one two three four five six"), (0, "seven eight"),
            (2, "alpha beta gamma delta epsilon zeta")]
    left = one_of_each(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    assert sorted(tuple(r) for r in left.collect()) == sorted([rows[0], rows[1], rows[3]])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(st.sampled_from("aAbB é　\n\t|!") | st.characters(codec="utf-8"), max_size=60), max_size=6), st.integers(1, 5))
def test_shingle_hashes(texts, size):
    import pyarrow as pa
    seen = {}
    for part in chunks(pa.array(texts, pa.string()), 40):
        data = lower(part.data)
        w = words(data, part.offsets)
        hashes, begin = shingle_hashes(span_hashes(data, w.start, w.end), w.first, size)
        for i in range(len(part)):
            own = texts[part.first + i].encode().lower().split()
            want = [tuple(own[k:k + size]) for k in range(max(1, len(own) - size + 1))] if own else []
            got = hashes[begin[i]:begin[i + 1]].tolist()
            assert len(got) == len(want)
            for key, value in zip(want, got, strict=True):
                assert seen.setdefault(key, value) == value
    assert len(set(seen.values())) == len(seen)


def test_words_that_differ_in_their_last_byte():
    import pyarrow as pa
    texts = [f"abcdefg{chr(c)}" for c in range(33, 127)] + [f"abcdefgh{chr(c)}" for c in range(33, 127)]
    (part,) = chunks(pa.array(texts))
    w = words(part.data, part.offsets)
    assert len(set(span_hashes(part.data, w.start, w.end).tolist())) == len(texts)
