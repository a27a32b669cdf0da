"""Partial matching against a dictionary of contexts, and the base score against counters."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from rosterlift.llm import queries
from rosterlift.llm.lm import END, PartialMatching, Table, language_scores


class Plain:
    """The same model, a byte at a time."""

    def __init__(self, texts, order, share):
        self.order, seen = order, [defaultdict(Counter) for _ in range(order + 1)]
        n = 0
        for t in texts:
            line = bytes([END]) * order + t.encode().lower() + bytes([END])
            for i in range(order, len(line)):
                n += 1
                for d in range(order + 1):
                    seen[d][line[i - d:i]][line[i]] += 1
        least = max(1, math.ceil(n * share))
        self.nodes = []
        for level in seen:
            kept = {c: (sum(f.values()), len(f), {s: k for s, k in f.items() if k >= least}) for c, f in level.items()}
            self.nodes.append({c: v for c, v in kept.items() if v[2]})

    def log(self, context, symbol):
        ruled, total = {}, 0.0
        for d in range(self.order, -1, -1):
            node = self.nodes[d].get(context[len(context) - d:])
            if node is None:
                continue
            count, distinct, kept = node
            rest = count + distinct - sum(kept[s] for s in ruled) - len(ruled)
            if symbol in kept:
                return total + math.log10(kept[symbol] / rest)
            free = rest - sum(k for s, k in kept.items() if s not in ruled)
            total += math.log10(free / rest) if rest else 0.0
            ruled = kept
        return total - math.log10(max(1, 256 - len(ruled)))

    def score(self, text):
        line = bytes([END]) * self.order + text.encode().lower() + bytes([END])
        return sum(self.log(line[i - self.order:i], line[i]) for i in range(self.order, len(line)))


def held(i):
    return zlib.crc32(str(i).encode() if i is not None else b"") % 10 == 0


def base(rows):
    tokens = {i: [*(t or "").encode().lower().split(), None] for i, t in rows}
    c = Counter(w for i, t in tokens.items() if not held(i) for w in t)
    n, v = sum(c.values()), len(c)
    return {i: (len(t), sum(c[w] > 0 for w in t), n, sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in t)) for i, t in tokens.items()}


def run(df, **p):
    number = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return {r.doc_id: r for r in language_scores(df, F.crc32(number) % 10 == 0, PartialMatching(**p)).collect()}


@pytest.mark.parametrize("p", [{"order": 2, "share": 1e-9, "word_share": 1.0}, {"order": 4, "share": 0.002, "word_share": 0.01}, {"order": 0, "share": 0.05}])
def test_scores(docs, p):
    rows = [(i, t) for i, t in enumerate(["the cat sat on the mat", "The Cat\tsat", "", None, "é à la carte, là-bas", "zzzz zz z",
                                          "a" * 300, "the mat sat on the cat " * 20, "中文 \U0001f600", "x\n\ny  z"] * 3)]
    got, want = run(docs(rows), **p), base(rows)
    model = Plain([t or "" for i, t in rows if not held(i)], p["order"], p["share"])
    for i, t in rows:
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held(i), *want[i][:3])
        assert r.base_score == pytest.approx(want[i][3], rel=1e-9)
        assert r.score == pytest.approx(model.score(t or ""), rel=1e-9)


def test_probabilities_of_a_context_add_up_to_one(docs):
    texts = ["abracadabra", "abc abd", "cab"]
    model = Plain(texts, 3, 1e-9)
    for context in (b"\xff\xff\xff", b"bra", b"abz", b"zzz", b" ab"):
        assert sum(10**model.log(context, s) for s in range(256)) == pytest.approx(1)


def test_whole_table(spark, small):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    got = {r.doc_id: r for r in queries.op3_partial_matching_scores(spark, small).collect()}
    for i, want in base(rows).items():
        assert (got[i].n_tokens, got[i].n_known, got[i].train_tokens) == want[:3]
        assert got[i].base_score == pytest.approx(want[3], rel=1e-9)
    p = PartialMatching()
    model = Plain([t for i, t in rows if not held(i)], p.order, p.share)
    for i, t in rows[:20]:
        assert got[i].score == pytest.approx(model.score(t), rel=1e-9)


def test_nothing_counted_is_lost(docs):
    # Nine million positions: an entry seen once is below a 2^-22 share of them.
    texts = ["ab " * 100_000] * 33 + ["qz", "zq xj"]
    rows = [(i, t) for i, t in enumerate(texts) if i < 33] + [(i, t) for i, t in zip([j for j in range(33, 60) if not held(j)], texts[33:])]
    got = run(docs(rows), order=1)
    model = Plain([t for i, t in rows if not held(i)], 1, 1e-12)
    for i, t in rows[:1] + rows[33:]:
        assert got[i].score == pytest.approx(model.score(t), rel=1e-9)


@pytest.mark.parametrize("p", [{"order": 3, "frequent": 1.0}, {"order": 5, "frequent": 0.01}, {"order": 0, "frequent": 0.05}, {"order": 2, "share": 0.004, "frequent": 0.02}])
def test_rare_entries_are_joined(docs, p):
    texts = ["the cat sat on the mat", "xq", "The Dog\tran", "", None, "\u00e9 \u00e0 la carte, l\u00e0-bas", "a" * 300, "the mat sat on the cat " * 20, "x\n\ny  z"]
    rows = [(i, f"{t or ''} {i % 7}" if i % 4 else t) for i, t in enumerate(texts * 4)]
    got = run(docs(rows), **p)
    model = Plain([t or "" for i, t in rows if not held(i)], p["order"], p.get("share", 1e-12))
    for i, t in rows:
        assert got[i].score == pytest.approx(model.score(t or ""), rel=1e-9)


def test_empty_table_no_training_rows_and_repeats(docs):
    assert run(docs([])) == {}
    got = run(docs([(None, "a b"), (None, "a b")]))  # an empty number is held out
    assert got[None].held_out and (got[None].n_tokens, got[None].n_known, got[None].train_tokens, got[None].base_score) == (3, 0, 0, 0.0)
    assert got[None].score == pytest.approx(-4 * math.log10(256))


def test_table_finds_what_it_holds_in_place():
    rng = np.random.default_rng(5)
    keys = np.unique(rng.integers(0, 1 << 63, 300_000).astype(np.uint64))
    rng.shuffle(keys)
    held, others = keys[:200_000], keys[200_000:]
    table = Table(held)
    assert (table.find(held) == np.arange(len(held))).all() and (table.find(others) == -1).all()
    assert table.keys is held and table.slots.nbytes <= 4 * 5 * len(held)
    assert (Table(held[:0]).find(others) == -1).all() and len(table.find(held[:0])) == 0
