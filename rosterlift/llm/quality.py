"""Quality rules: counts that reject a text outright, then a classifier trained on labelled rows.

The classifier is a logistic regression on hashed word and character n-grams. A block of n-grams (words, pairs of words,
three and four characters) enters as the relative frequencies of its hash buckets, so long and short texts compare. A
fifth of the training rows is held back to calibrate the scores into probabilities, which a fixed threshold cuts.

It is fitted on at most ``sample`` labelled rows (those whose ids have the smallest hashes) and at most ``cells`` distinct
buckets of theirs, eight bytes each, in one task; the rows come in the order of the hashes, and the first that would go beyond
is left out with all after it. Loss and slope are added up over blocks of cells, so the task holds those bytes and little
more. The weights are a few arrays of fixed size. Counts and scores cover every row's whole text, in Arrow batches.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._store import prepare
from ._text import U, Texts, Words, chunks, mix, shingle_hashes, span_hashes, words

SYMBOLS = b"#*$%&|<>"
_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[list(SYMBOLS)] = True
_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class QualityRules:
    sample: int = 6000  # labelled rows to learn from, at most
    cells: int = 32_000_000  # distinct buckets of these rows, at most
    bits: int = 15  # hash buckets of each block: 2 ** bits
    decay: float = 1e-6
    steps: int = 60
    threshold: float = 0.5  # least probability of good quality
    min_words: int = 50
    max_repeat_percent: int = 50


def _per_text(marks: np.ndarray, edges: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(marks)])
    return total[edges[1:]] - total[edges[:-1]]


def _repeated_lines(part: Texts) -> list[int]:
    raw, out = part.data.tobytes(), []
    for a, b in zip(part.offsets[:-1].tolist(), part.offsets[1:].tolist(), strict=True):
        lines, seen, again = raw[a:b].split(b"\n"), set(), 0
        if len(lines) > 1:
            for line in lines:
                if line in seen:
                    again += bool(line.strip(b" \t\n\x0b\x0c\r"))
                else:
                    seen.add(line)
        out.append(again)
    return out


def counts(part: Texts, w: Words, hashes: np.ndarray) -> dict[str, np.ndarray]:
    """The base counts of each text."""
    own = w.counts
    word_bytes = np.zeros(len(part.data) + 1, np.int8)
    word_bytes[w.start] += 1
    word_bytes[w.end] -= 1
    in_word = np.cumsum(word_bytes[:-1]).astype(bool)
    threes, begin = shingle_hashes(hashes, w.first, 3)
    text_of = np.repeat(np.arange(len(part)), np.diff(begin)).astype(np.uint64)
    _, which, times = np.unique(mix(threes ^ mix(text_of + U(1))), return_inverse=True, return_counts=True)
    again = times[which] > 1
    at = (np.arange(len(threes)) + np.repeat(w.first[:-1] - begin[:-1], np.diff(begin)))[again]
    covered = np.zeros(len(hashes) + 2, bool)
    for k in range(3):
        covered[at + k] = True
    return {"n_words": own, "word_chars": _per_text(in_word & ((part.data & 0xC0) != 0x80), part.offsets),
            "n_symbols": _per_text(_IS_SYMBOL[part.data], part.offsets),
            "n_dup_lines": np.array(_repeated_lines(part), np.int64), "n_repeat_words": _per_text(covered[:len(hashes)], w.first)}


def blocks(part: Texts, w: Words, hashes: np.ndarray, bits: int):
    """For each block of n-grams: the bucket of every n-gram, and where each text's begin."""
    drop = U(64 - bits)
    yield (hashes >> drop).astype(np.int32), w.first
    pairs, begin = shingle_hashes(hashes, w.first, 2)
    yield (pairs >> drop).astype(np.int32), begin
    points = np.frombuffer(part.data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), "<u4").astype(np.uint64)
    edges = np.concatenate([[0], np.cumsum((part.data & 0xC0) != 0x80)])[part.offsets]
    for n in (3, 4):
        size = np.maximum(np.diff(edges) - n + 1, 0)
        begin = np.concatenate([[0], np.cumsum(size)])
        key = np.zeros(max(len(points) - n + 1, 0), np.uint64)
        for k in range(n):
            key = key * U(0x9E3779B97F4A7C15) + points[k:k + len(key)]
        at = np.repeat(edges[:-1] - begin[:-1], size) + np.arange(begin[-1])
        yield (mix(key[at] + U(n)) >> drop).astype(np.int32), begin


N_BLOCKS = 4


def _features(bits: int):
    """Distinct buckets of each text with their relative frequencies, for training."""
    def run(batches):
        for batch in batches:
            for part in chunks(batch.column(2)):
                w = words(part.data, part.offsets)
                hashes = span_hashes(part.data, w.start, w.end)
                cells: list[list[np.ndarray]] = [[] for _ in range(len(part))]
                for k, (bucket, begin) in enumerate(blocks(part, w, hashes, bits)):
                    for i in range(len(part)):
                        b, n = np.unique(bucket[begin[i]:begin[i + 1]], return_counts=True)
                        cells[i].append(np.stack([b + (k << bits), n / max(1, n.sum())]))
                rows = [np.concatenate(c, axis=1) for c in cells]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(part.first, len(part)),
                     batch.column(1).slice(part.first, len(part)),
                     pa.array([r[0].astype("<i4").tobytes() for r in rows], pa.binary()),
                     pa.array([r[1].astype("<f4").tobytes() for r in rows], pa.binary())], ["turn", "quality", "bucket", "share"])
    return run


def _minimise(f, x: np.ndarray, steps: int, memory: int = 8) -> np.ndarray:
    """Limited-memory BFGS with a halving line search; f gives a value and a gradient."""
    value, slope = f(x)
    s, y = [], []
    for _ in range(steps):
        d, a = -slope, []
        for si, yi in zip(reversed(s), reversed(y), strict=True):
            a.append((si @ d) / (si @ yi))
            d = d - a[-1] * yi
        if s:
            d = d * ((s[-1] @ y[-1]) / (y[-1] @ y[-1]))
        for si, yi, ai in zip(s, y, reversed(a), strict=True):
            d = d + (ai - (yi @ d) / (si @ yi)) * si
        t, down = 1.0, slope @ d
        while t > 1e-8:
            new, slope_new = f(x + t * d)
            if new <= value + 1e-4 * t * down:
                break
            t /= 2
        else:
            break
        if (t * d) @ (slope_new - slope) > 1e-12:
            s, y = [*s, t * d][-memory:], [*y, slope_new - slope][-memory:]
        x, value, slope = x + t * d, new, slope_new
    return x


def _logistic(z: np.ndarray, target: np.ndarray) -> tuple[float, np.ndarray]:
    p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    return float(np.mean(np.logaddexp(0, z) - target * z)), (p - target) / len(z)


_BLOCK_CELLS = 1 << 20


class Rows:
    """Training rows in blocks of some million cells: buckets and shares one after the other, and how many each row has."""

    def __init__(self) -> None:
        self.blocks: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self._open: list[tuple[np.ndarray, np.ndarray]] = []
        self._targets: list[int] = []
        self._size = 0

    def add(self, target: int, bucket: bytes, share: bytes) -> None:
        self._targets.append(target)
        self._open.append((np.frombuffer(bucket, "<i4"), np.frombuffer(share, "<f4")))
        self._size += len(self._open[-1][0])
        if self._size >= _BLOCK_CELLS:
            self.close()

    def close(self) -> None:
        if self._open:
            bucket, share = (np.concatenate(x) for x in zip(*self._open, strict=True))
            self.blocks.append((bucket, share, np.array([len(x) for x, _ in self._open])))
            self._open, self._size = [], 0

    @property
    def targets(self) -> np.ndarray:
        return np.array(self._targets, float)

    def scores(self, x: np.ndarray) -> np.ndarray:
        out = [np.bincount(np.repeat(np.arange(len(n)), n), share * x[bucket], len(n)) for bucket, share, n in self.blocks]
        return np.concatenate(out) if out else np.zeros(0)

    def slope(self, dz: np.ndarray, size: int) -> np.ndarray:
        """The scores' slope at the weights, for changes ``dz`` of the scores."""
        out, at = np.zeros(size), 0
        for bucket, share, n in self.blocks:
            out += np.bincount(bucket, share * np.repeat(dz[at:at + len(n)], n), size)
            at += len(n)
        return out


def gather(rows: Iterable[tuple[int, bytes, bytes]], cells: int) -> tuple[Rows, Rows]:
    """Rows to learn from and, every fifth, to calibrate with, as long as there is room for their cells."""
    train, held, size = Rows(), Rows(), 0
    for i, (target, bucket, share) in enumerate(rows):
        size += len(bucket) // 4
        if size > cells:
            break
        (held if i % 5 == 4 else train).add(target, bucket, share)
    train.close()
    held.close()
    return train, held


def fit(train: Rows, held: Rows, rules: QualityRules) -> np.ndarray | None:
    """Weights of all blocks, then slope and intercept of the calibrated score; None if one class only is known."""
    targets, held_targets = train.targets, held.targets
    if len(set(targets.tolist())) < 2 or len(set(held_targets.tolist())) < 2:
        return None
    size = N_BLOCKS << rules.bits

    def loss(x):
        value, dz = _logistic(train.scores(x) + x[-1], targets)
        slope = np.append(train.slope(dz, size), dz.sum())
        slope[:-1] += rules.decay * x[:-1]
        return value + rules.decay / 2 * float(x[:-1] @ x[:-1]), slope

    x = _minimise(loss, np.zeros(size + 1), rules.steps)
    z = held.scores(x) + x[-1]
    center, spread = float(np.mean(z)), float(np.std(z)) or 1.0

    def calibrate(v):
        u = (z - center) / spread
        value, du = _logistic(v[0] * u + v[1], held_targets)
        return value + 5e-4 * float(v @ v), np.array([du @ u, du.sum()]) + 1e-3 * v

    a, b = _minimise(calibrate, np.array([1.0, 0.0]), 50)
    return np.concatenate([x[:-1], [a / spread, b + a * (x[-1] - center) / spread]]).astype(np.float32)


def _fit(rules: QualityRules):
    def run(batches):
        train, held = gather((row for b in batches for row in zip(*(b.column(i).to_pylist() for i in (1, 2, 3)), strict=True)), rules.cells)
        model = fit(train, held, rules)
        if model is not None:
            yield pa.RecordBatch.from_arrays([pa.array([model.tobytes()], pa.binary())], ["model"])
    return run


def _base_failed(n: dict[str, np.ndarray], rules: QualityRules) -> np.ndarray:
    return (n["n_words"] < rules.min_words) | (100 * n["n_repeat_words"] > rules.max_repeat_percent * n["n_words"])


def _verdicts(column: pa.Array, model: np.ndarray | None, rules: QualityRules):
    """For each piece of a column of texts: the piece, its counts, what fails by them, and the probabilities of good quality."""
    for part in chunks(column):
        w = words(part.data, part.offsets)
        hashes = span_hashes(part.data, w.start, w.end)
        n = counts(part, w, hashes)
        p = np.ones(len(part))
        if model is not None:
            z = np.zeros(len(part))
            for k, (bucket, begin) in enumerate(blocks(part, w, hashes, rules.bits)):
                share = model[bucket + (k << rules.bits)].astype(float) / np.repeat(np.maximum(np.diff(begin), 1), np.diff(begin))
                z += np.bincount(np.repeat(np.arange(len(part)), np.diff(begin)), share, len(part))
            p = 1 / (1 + np.exp(-np.clip(model[-2] * z + model[-1], -30, 30)))
        yield part, n, _base_failed(n, rules), p


def _judge(model: np.ndarray | None, rules: QualityRules):
    def run(batches):
        for batch in batches:
            for part, n, failed, p in _verdicts(batch.column(1), model, rules):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(part.first, len(part)), *[pa.array(n[c].astype(np.int64)) for c in _COUNTS],
                     pa.array(failed), pa.array(p), pa.array(~failed & (p >= rules.threshold))],
                    ["doc_id", *_COUNTS, "base_failed", "probability", "kept"])
    return run


def train(docs: DataFrame, labels: DataFrame, rules: QualityRules = QualityRules()) -> np.ndarray | None:
    """The classifier's weights, learnt from labelled rows that the counts alone do not reject.

    Labels without an id or with a quality other than 0 and 1 are left out; of several labels of an id the lowest
    counts, of several texts the greatest. None if there are not both classes to learn from.
    """
    known = labels.where("doc_id IS NOT NULL AND quality IN (0, 1)").groupBy(F.col("doc_id").cast("long").alias("id"))
    known = known.agg(F.min("quality").cast("long").alias("quality")).orderBy(F.xxhash64("id"), "id").limit(rules.sample)
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))
    # At most `sample` rows of 16 bytes.
    rows = texts.join(F.broadcast(known), "id").groupBy("id", "quality").agg(F.max("text").alias("text"))
    rows = rows.select(F.xxhash64("id").alias("turn"), "quality", "text").mapInArrow(_only_passing(rules), "turn long, quality long, text string")
    features = rows.mapInArrow(_features(rules.bits), "turn long, quality long, bucket binary, share binary")
    found = features.repartition(1).sortWithinPartitions("turn").mapInArrow(_fit(rules), "model binary").first()
    return None if found is None else np.frombuffer(found[0], np.float32)


def _keep(model: np.ndarray | None, rules: QualityRules, text: int):
    def run(batches):
        for batch in batches:
            keep = [~failed & (p >= rules.threshold) for _, _, failed, p in _verdicts(batch.column(text), model, rules)]
            yield batch.filter(pa.array(np.concatenate([np.zeros(0, bool), *keep])))
    return run


def good_documents(docs: DataFrame, labels: DataFrame, rules: QualityRules = QualityRules()) -> DataFrame:
    """The rows of ``docs`` that ``judged`` keeps, with all their columns, whatever these are called."""
    prepare(docs.sparkSession)
    model = train(docs, labels, rules)
    return docs.mapInArrow(_keep(model, rules, docs.columns.index("text")), docs.schema)


def _only_passing(rules: QualityRules):
    def run(batches):
        for batch in batches:
            keep = [np.zeros(0, bool)]
            for part in chunks(batch.column(2)):
                w = words(part.data, part.offsets)
                keep.append(~_base_failed(counts(part, w, span_hashes(part.data, w.start, w.end)), rules))
            yield batch.filter(pa.array(np.concatenate(keep)))
    return run


def judged(docs: DataFrame, labels: DataFrame, rules: QualityRules = QualityRules()) -> DataFrame:
    """``doc_id``, the counts, ``base_failed``, ``probability`` (of good quality) and ``kept`` of every row of ``docs``.

    Null and empty texts have no words and fail. Without labels of both classes the counts alone decide. Rows are
    judged one by one: null or repeated ids and other columns do not matter.
    """
    prepare(docs.sparkSession)
    model = train(docs, labels, rules)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    kinds = ", ".join(f"{c} long" for c in _COUNTS)
    return texts.mapInArrow(_judge(model, rules), f"doc_id long, {kinds}, base_failed boolean, probability double, kept boolean")
