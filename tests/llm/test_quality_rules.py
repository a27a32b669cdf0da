"""Quality counts against plain counting; the classifier against held-out labels."""

import random
import re
from collections import Counter

import numpy as np

from rosterlift.llm import queries
from rosterlift.llm.quality import QualityRules, gather, good_documents, judged, train

LABELS = "doc_id long, quality int, toxic int"


def counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    threes = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if threes[tuple(words[i:i + 3])] > 1 for k in range(3)}
    seen, again = set(), 0
    for line in text.split("\n"):
        again += line in seen and bool(re.search(r"[^\x20\x09-\x0D]", line))
        seen.add(line)
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), again, len(covered), failed


def got(df):
    return [(r.doc_id, (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)) for r in df.collect()]


def test_whole_table(spark, small):
    rows = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    found = queries.op7_quality_rules(spark, small).collect()
    by_id = {r.doc_id: r for r in found}
    assert len(found) == len(rows)
    for r in rows:
        x = by_id[r.doc_id]
        assert (x.n_words, x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat_words, x.base_failed) == counts(r.text)
        assert not (x.base_failed and x.kept)


def test_odd_texts(spark, docs):
    long = " ".join(f"w{i}" for i in range(60))
    rows = [(1, ""), (2, None), (None, long), (4, f"a|b\n\n a|b\n a|b\n\x0b\n\x0b\n {long}"), (4, "x y z " * 40), (5, "é é é\xa0é é é é"),
            (6, "a b a b a b"), (7, "\n".join(["l"] * 5)), (8, f"{long} w0 w1 w2"), (9, "q" * 10_000)]
    found = got(judged(docs(rows), spark.createDataFrame([], LABELS)))
    assert sorted(found, key=str) == sorted(((i, counts(t)) for i, t in rows), key=str)
    assert judged(docs([]), spark.createDataFrame([], LABELS)).collect() == []


def test_classifier_on_rows_it_has_not_seen(spark, docs):
    rng = random.Random(4)

    def text(good):
        words = ["".join(rng.choice("aeiou" if k % 2 else "bdklmnrst") for k in range(rng.randrange(2, 8))) for _ in range(rng.randrange(60, 120))]
        return " ".join(words if good else [w.upper() + rng.choice(("!!", "$%", " |")) for w in words])
    rows = [(i, i % 4 > 0, text(i % 4 > 0)) for i in range(800)]
    labels = spark.createDataFrame([(i, int(g), 0) for i, g, _ in rows if i < 500] + [(None, 1, 0), (3, None, 0), (3, 5, 0)], LABELS)
    df = docs([(i, t) for i, _, t in rows])
    verdicts = {r.doc_id: r for r in judged(df, labels).collect()}
    unseen = [(g, verdicts[i]) for i, g, _ in rows if i >= 500]
    assert sum(g == v.kept for g, v in unseen) >= 0.98 * len(unseen)
    assert sum((g - v.probability)**2 for g, v in unseen) < 0.03 * len(unseen)  # calibrated
    extra = df.selectExpr("lang AS kept", "doc_id", "n_chars AS probability", "text")
    left = good_documents(extra, labels)
    assert left.columns == extra.columns
    assert {r.doc_id for r in left.collect()} == {i for i, v in verdicts.items() if v.kept}


def test_labels_of_one_class_teach_nothing(spark, docs):
    df = docs([(i, " ".join(f"w{i}{k}" for k in range(60))) for i in range(20)])
    assert train(df, spark.createDataFrame([(i, 1, 0) for i in range(20)], LABELS)) is None
    assert train(df, spark.createDataFrame([], LABELS), QualityRules()) is None


def test_blocks_add_up_and_cells_are_bounded():
    rng = np.random.default_rng(2)
    rows = [(int(n % 2), rng.integers(0, 1000, n).astype("<i4"), rng.random(n).astype("<f4")) for n in rng.integers(0, 900_000, 12)]
    packed = [(t, b.tobytes(), s.tobytes()) for t, b, s in rows]
    train_rows, held = gather(packed, 10**9)
    assert len(train_rows.blocks) > 1 and len(train_rows.targets) == 10 and len(held.targets) == 2
    x, mine = rng.random(1000), [r for i, r in enumerate(rows) if i % 5 != 4]
    assert np.allclose(train_rows.scores(x), [s.astype(float) @ x[b] for _, b, s in mine])
    dz, slope = rng.random(10), np.zeros(1000)
    for d, (_, b, s) in zip(dz, mine):
        np.add.at(slope, b, s * d)
    assert np.allclose(train_rows.slope(dz, 1000), slope, rtol=1e-4)
    few = gather(packed, sum(len(b) for _, b, _ in rows[:7]))
    assert [len(r.targets) for r in few] == [6, 1]


def test_training_on_very_long_texts_keeps_to_its_cells():
    import tracemalloc
    row = (np.arange(131_072, dtype="<i4").tobytes(), np.full(131_072, 1e-5, "<f4").tobytes())
    tracemalloc.start()
    train_rows, held = gather(((i % 2, *row) for i in range(6000)), 8_000_000)
    model_room = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(train_rows.targets) + len(held.targets) == 8_000_000 // 131_072
    assert model_room < 8_000_000 * 8 * 1.5
