"""Each stage of the pipeline on what the stage before has left, against brute force."""

import corpus_pipeline
import public_tokenizers
import pytest
from test_lines import brute as brute_lines
from test_minhash import brute as brute_groups
from test_quality_rules import counts
from test_secrets import spans
from test_tokens import check_packed
from tokenizers import Tokenizer

from rosterlift.llm._store import Scratch


@pytest.fixture(scope="module")
def steps(spark, small):
    scratch, docs = Scratch(spark), spark.read.parquet(f"{small}/documents.parquet")
    out = [("documents", docs.collect(), docs.columns)]
    for name, stage in corpus_pipeline.STAGES:
        docs = scratch.keep(stage(spark, docs, small), name)
        out.append((name, docs.collect(), docs.columns))
    return {name: (before[1], rows, columns) for before, (name, rows, columns) in zip(out, out[1:], strict=False)}


def test_stages(steps):
    assert [*steps] == ["quality_rules", "line_dedup", "near_dedup", "secret_scan", "packing"]
    assert all(steps[s][2] == ["doc_id", "text", "lang", "source", "n_chars"] for s in [*steps][:-1])


def test_quality(steps, spark, small):
    before, after, _ = steps["quality_rules"]
    kept = {r.doc_id for r in after}
    assert {tuple(r) for r in after} <= {tuple(r) for r in before}
    assert all(r.doc_id not in kept for r in before if counts(r.text)[-1])
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{small}/labels.parquet").collect()}
    passing = [r for r in before if not counts(r.text)[-1] and r.doc_id in labels]
    assert sum((r.doc_id in kept) == labels[r.doc_id] for r in passing) >= 0.95 * len(passing)


def test_lines(steps):
    before, after, _ = steps["line_dedup"]
    found = brute_lines([(r.doc_id, r.text) for r in before], 2, 20)
    want = {}
    for r in before:
        lines = r.text.split("\n")
        left = [line for n, line in enumerate(lines) if found.get((r.doc_id, n), (None, True))[1]]
        if len(left) == len(lines) or "\n".join(left).split():
            want[r.doc_id] = "\n".join(left)
    assert {r.doc_id: r.text for r in after} == want and all(r.n_chars == len(r.text) for r in after)


def test_groups(steps):
    before, after, _ = steps["near_dedup"]
    found = brute_groups([(r.doc_id, r.text) for r in before], 5)
    assert {tuple(r) for r in after} == {tuple(r) for r in before if found[r.doc_id][2]}


def test_secrets(steps):
    before, after, _ = steps["secret_scan"]
    texts = {r.doc_id: r.text for r in before}
    assert {r.doc_id for r in after} == set(texts)
    for r in after:
        assert not any(spans(r.text).values())
        if not any(spans(texts[r.doc_id]).values()) and "[secret]" not in r.text:
            assert r.text == texts[r.doc_id]


def test_packing(steps):
    before, after, _ = steps["packing"]
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    check_packed(after, [(r.doc_id, [*t.encode(r.text, add_special_tokens=False).ids, 0]) for r in before], 1024)


def test_registered(spark, small, steps):
    assert corpus_pipeline.run(spark, small).count() == len(steps["packing"][1])
