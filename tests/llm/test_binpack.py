"""Minimum bin slack: fullest bins against enumeration, ids against the file's own library, whole packings."""

import itertools
import math
import struct
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from rosterlift.llm import binpack, queries

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = ["", " ", "\n\t", "Don't STOP, 3.14!! <|endoftext|> x<|startoftext|>y", "<|ENDOFTEXT|>", "é é ́x Σας ΣΑΣ", "漢字\U0001f642 a b\x1cc\x85d",
       "x" * 500, "a b\r\nc\x0bd\x0ce", "ﬁ ŉ İ ǅ ẞ", "가 가"]


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    return lambda text: t.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.dictionaries(st.integers(1, 20), st.integers(1, 3), min_size=1, max_size=6), st.integers(20, 30))
def test_fullest_bin(left, capacity):
    largest = max(left)
    rest = [n for n, k in left.items() for _ in range(k - (n == largest))]
    best = max(sum(c) for r in range(len(rest) + 1) for c in itertools.combinations(rest, r) if largest + sum(c) <= capacity)
    got = binpack.fullest(left, capacity)
    assert sum(n * k for n, k in got.items()) == largest + best
    assert got[largest] >= 1 and all(k <= left[n] for n, k in got.items())


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 50), max_size=8))
def test_a_plan_places_every_piece_once(counts):
    found = binpack.plan(counts, 40)
    taken = Counter()
    for n, k in counts.items():
        sequence, offset = found.place(np.full(k, n), np.arange(k))
        taken.update((s, o + i) for s, o in zip(sequence.tolist(), offset.tolist()) for i in range(n))
    assert all(v == 1 for v in taken.values()) and sum(taken.values()) == sum(n * k for n, k in counts.items())
    fill = Counter(s for s, _ in taken)
    assert set(fill) == set(range(found.sequences)) and all((s, o) in taken for s, k in fill.items() for o in range(k))
    assert max(fill.values(), default=0) <= 40


def test_long_runs_of_a_length_need_few_steps():
    found = binpack.plan({n: 10**9 + 7 * n for n in range(1, 4097, 3)}, 4096)
    assert len(found.key) < 20_000
    total = sum(n * (10**9 + 7 * n) for n in range(1, 4097, 3))
    assert found.sequences <= 1.001 * total / 4096


@settings(max_examples=150, deadline=None)
@given(st.text(st.one_of(st.sampled_from(" \n\t'.<|>sStrȩ́́Σ "), st.characters(exclude_categories=["Cs"])), max_size=40))
def test_ids_are_the_library_s(text):
    t = Tokenizer.from_file(PATH)
    assert binpack.word_ids(PATH).ids(text.encode()) == struct.pack(f"<{len(x)}I", *x) if (x := t.encode(text, add_special_tokens=False).ids) else True


def check(rows, texts, library, capacity, end):
    """All contract columns, from the texts alone; returns the number of sequences and the least possible."""
    want = Counter()
    for doc, text in texts:
        ids = [*library(text or ""), end]
        for piece, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at:at + capacity]
            want[doc, piece, at, len(part), zlib.crc32(struct.pack(f"<{len(part)}I", *part))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for held in bins.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins), math.ceil(sum(r.length for r in rows) / capacity)


def test_whole_table(spark, small, library):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = queries.op11_minimum_bin_slack(spark, small).collect()
    bins, least = check(rows, [(r.doc_id, r.text) for r in docs.collect()], library, 4096, 1)
    assert bins <= least + 1


def test_odd_texts_repeated_ids_nulls_and_small_sequences(spark, docs, library):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(0, "again"), (0, "again"), (None, "lost"), (99, None)] + [(100 + i, "the cat " * i) for i in range(60)]
    got = binpack.packed_fullest(docs(rows).repartition(5), PATH, capacity=16).collect()
    bins, least = check(got, rows, library, 16, 1)
    assert bins <= 1.1 * least
    assert all(zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length for r in got)


def test_special_strings_as_text(spark, docs):
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    row = binpack.packed_fullest(docs([(1, "a <|endoftext|> b")]), PATH, special_as_text=True).first()
    ids = [*t.encode("a <|endoftext|> b", add_special_tokens=False).ids, 1]
    assert bytes(row.ids) == struct.pack(f"<{len(ids)}I", *ids)
    binpack.word_ids.cache_clear()


def test_empty_table_clashing_names_and_a_very_long_text(spark, docs, library):
    assert binpack.packed_fullest(docs([]), PATH).count() == 0
    text = "lorem ipsum dolor " * 60_000
    table = docs([(7, text)]).withColumnsRenamed({"lang": "part", "source": "length", "n_chars": "nth"})
    check(binpack.packed_fullest(table, PATH).collect(), [(7, text)], library, 4096, 1)


def test_a_hot_length_is_spread_over_tasks(spark, docs):
    table = spark.range(30_000).selectExpr("id AS doc_id", "CASE WHEN id % 3 = 0 THEN 'a' ELSE repeat('b ', CAST(id % 90 AS INT)) END AS text")
    rows = binpack.packed_fullest(table.repartition(8), PATH, capacity=256).collect()
    assert len(rows) == 30_000 and len({(r.sequence_id, r.offset) for r in rows}) == 30_000
    assert len({r.sequence_id for r in rows}) <= math.ceil(sum(r.length for r in rows) / 256) + 1
