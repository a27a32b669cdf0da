"""Word pieces against greedy longest match, BPE against two libraries, packing against plain concatenation."""

import hashlib
import random
import struct
import zlib

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from rosterlift.llm import queries
from rosterlift.llm.bpe import PerfectHash, codec, encode_decode
from rosterlift.llm.packing import packed
from rosterlift.llm.wordpiece import WORD, LongestMatch, _counted, token_counts

MODEL, RANKS, JSON = (public_tokenizers.path(n) for n in ("piece_bpe_32k.model", "byte_bpe_50k.tiktoken", "byte_bpe_50k.json"))
ODD = ["", " ", "a", "\n\n \t x", "<|endoftext|> hi", "é漢字\U0001f642\U0001f642", "ⅷ\xb2٣ x\xb2 \xbd", "don't we'll I'D",
       "a" * 3000, " " * 2000, "ab " * 1000, "▁x ▁", "x_y z-9 __"]


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(JSON)
    t.encode_special_tokens = True
    return lambda text: t.encode(text, add_special_tokens=False).ids


@pytest.fixture(scope="module")
def delivered():
    """The library as it is, which takes the strings of special tokens for these tokens."""
    t = Tokenizer.from_file(JSON)
    return lambda text: t.encode(text, add_special_tokens=False).ids


def greedy(word, begin, inner):
    n, at, pieces = 0, 0, begin
    while at < len(word):
        end = next((e for e in range(len(word), at, -1) if word[at:e] in pieces), None)
        if end is None:
            return None
        n, at, pieces = n + 1, end, inner
    return n


@settings(max_examples=200, deadline=None)
@given(st.sets(st.text("abc", min_size=1, max_size=5), max_size=12), st.sets(st.text("abc", min_size=1, max_size=5), max_size=12), st.text("abcd", max_size=30))
def test_longest_match(begin, inner, word):
    assert LongestMatch(begin, inner).count(word) == greedy(word, begin, inner)


def whole(word, begin, inner):
    """Greedy pieces; a bare mark where none begins the word, bytes where none goes on."""
    n, at, pieces = 0, 0, begin
    while at < len(word):
        end = next((e for e in range(len(word), at, -1) if word[at:e] in pieces), None)
        if end is not None:
            n, at = n + 1, end
        elif pieces is begin:
            n += 1
        else:
            n, at = n + len(word[at].encode()), at + 1
        pieces = inner
    return n


@settings(max_examples=200, deadline=None)
@given(st.sets(st.text("ab\u00e9", min_size=1, max_size=5), max_size=12), st.sets(st.text("ab\u00e9", min_size=1, max_size=5), max_size=12),
       st.text("ab\u00e9\u6f22", max_size=30))
def test_longest_match_of_whole_words(begin, inner, word):
    assert LongestMatch(begin, inner, whole=True).count(word) == whole(word, begin, set(inner))


def test_pieces_of_words_without_a_beginning(docs):
    import sentencepiece
    m = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    pieces = [m.id_to_piece(i) for i in range(m.get_piece_size()) if not (m.is_control(i) or m.is_unknown(i) or m.is_byte(i))]
    begin, inner = {p[1:] for p in pieces if p[0] == "▁" and len(p) > 1}, {p for p in pieces if "▁" not in p}
    rows = [*enumerate([*ODD, "2024 a\u00f1os", "\u00f1and\u00fa", "\u6f22" * 1000, "7" * 400, "the cat"]), (None, None)]
    got = {r.doc_id: r for r in token_counts(docs(rows), MODEL).collect()}
    for i, t in rows:
        found = [whole(w, begin, inner) for w in WORD.findall(t or "")]
        assert got[i].n_tokens == sum(found)
    assert got[len(ODD) + 2].n_letters_only == 1 and got[len(ODD) + 2].n_tokens > 1000


def test_piece_counts(spark, small, docs):
    automaton = _counted(MODEL).automaton
    import sentencepiece
    m = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    pieces = [m.id_to_piece(i) for i in range(m.get_piece_size()) if not (m.is_control(i) or m.is_unknown(i) or m.is_byte(i))]
    begin, inner = {p[1:] for p in pieces if p[0] == "▁" and len(p) > 1}, {p for p in pieces if "▁" not in p}

    def count(text):
        found = [greedy(w, begin, inner) for w in WORD.findall(text)]
        return len(found), sum(1 if n is None else n for n in found), sum(n is None for n in found)
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    got = {r.doc_id: (r.n_words, r.n_letters_only, r.n_unknown) for r in queries.op4_word_piece_counts(spark, small).collect()}
    assert got == {i: count(t) for i, t in rows}
    odd = [*enumerate(ODD), (None, None)]
    assert sorted((r.doc_id or -1, r.n_words, r.n_letters_only, r.n_unknown) for r in token_counts(docs(odd), MODEL).collect()) == sorted(
        (i or -1, *count(t or "")) for i, t in odd)
    assert token_counts(docs([]), MODEL).collect() == []
    assert automaton.count("x" * 100_000) > 0


def test_perfect_hash():
    rng = random.Random(2)
    keys = {rng.randbytes(rng.randrange(1, 9)): i for i in range(5000)}
    h = PerfectHash(keys)
    assert all(h.get(k) == v for k, v in keys.items()) and h.n == len(keys) and None not in h.keys
    assert all(h.get(k) is None for k in (rng.randbytes(10) for _ in range(1000)))
    assert PerfectHash({}).get(b"x") is None and PerfectHash({b"a": 3}).get(b"a") == 3


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=80))
def test_bpe_as_the_library(text):
    own = codec(RANKS, public_tokenizers.PATTERN)
    if not hasattr(test_bpe_as_the_library, "own"):
        test_bpe_as_the_library.own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=own.ranks, special_tokens={})
    ids = own.encode(text)
    assert ids.tolist() == test_bpe_as_the_library.own.encode_ordinary(text)
    assert own.decode(ids) == text.encode()


def test_bpe_whole_table(spark, small, library):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()}
    for r in queries.op6_byte_bpe(spark, small).collect():
        ids = library(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_bpe_odd_texts(docs, library):
    rows = [*enumerate(ODD), (None, None), (0, "again")]
    got = sorted(((r.doc_id or -1, r.ids, bytes(r.decoded)) for r in encode_decode(docs(rows), RANKS, public_tokenizers.PATTERN).collect()), key=str)
    assert got == sorted(((i or -1, library(t or ""), (t or "").encode()) for i, t in rows), key=str)
    assert encode_decode(docs([]), RANKS, public_tokenizers.PATTERN).collect() == []


def check_packed(pieces, ids, window):
    """Every id of every text once, sequences full and without gaps; ids: a list of (doc_id, ids)."""
    by_doc, by_sequence = {}, {}
    for r in pieces:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == {i for i, _ in ids}
    for i, own in ids:
        at = 0
        for r in sorted(by_doc[i], key=lambda r: r.start):
            part = own[r.start:r.start + r.length]
            assert (r.start, r.doc_tokens, r.length) == (at, len(own), len(part)) and part
            assert r.ids_crc32 == zlib.crc32(struct.pack(f"<{len(part)}I", *part))
            at += r.length
        assert at == len(own)
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    for s, rows in by_sequence.items():
        at = 0
        for r in sorted(rows, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at == window or (s == max(by_sequence) and at < window)


def test_packing_whole_table(spark, small, delivered):
    rows = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    check_packed(queries.op5_concatenate_and_cut(spark, small).collect(), [(r.doc_id, [*delivered(r.text), 0]) for r in rows], 1024)


@pytest.mark.parametrize("window", [1, 7, 64])
def test_packing_over_partitions(docs, delivered, window):
    rows = [(i, t) for i, t in enumerate([*ODD, None, "one two three " * 30])]
    df = docs(rows).repartition(5)
    pieces = packed(df, JSON, public_tokenizers.PATTERN, window=window).collect()
    check_packed(pieces, [(i, [*delivered(t or ""), 0]) for i, t in rows], window)


def test_packing_empty_and_repeated(docs):
    assert packed(docs([]), JSON, public_tokenizers.PATTERN).collect() == []
    pieces = packed(docs([(1, "a"), (1, "a"), (None, "a")]), JSON, public_tokenizers.PATTERN).collect()
    assert sorted(p.offset for p in pieces) == [0, 2, 4] and {p.doc_tokens for p in pieces} == {2}


def test_packing_takes_special_strings_as_asked(docs, library, delivered):
    text = "a<|endoftext|> b <|endoftext|><|endoftext|>c <|endof"
    assert 50256 in delivered(text) and 50256 not in library(text)
    for asked, encode in ((False, delivered), (True, library)):
        check_packed(packed(docs([(1, text)]), JSON, public_tokenizers.PATTERN, 8, special_as_text=asked).collect(), [(1, [*encode(text), 0])], 8)
