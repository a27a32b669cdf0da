"""Byte-level BPE: whole pre-tokens through a minimal perfect hash, all others by merging their bytes."""

from __future__ import annotations

import base64
import heapq
from functools import lru_cache
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._store import prepare

_REMEMBERED = 400_000


class PerfectHash:
    """Maps each of n keys to a number of its own below n, by hash and displace; other keys are found to be none.

    Keys fall into n / 4 buckets by their hash. Bucket by bucket, largest first, a displacement is searched that sends
    all the bucket's keys to free places; a bucket of one key notes a free place itself, as a negative number.
    """

    def __init__(self, keys: dict[bytes, int]):
        self.n = n = max(1, len(keys))
        self.m = m = max(1, n // 4)
        buckets: list[list[tuple[int, bytes]]] = [[] for _ in range(m)]
        for key in keys:
            h = xxhash.xxh3_64_intdigest(key)
            buckets[h % m].append((h, key))
        self.shift = [0] * m
        self.keys: list[bytes | None] = [None] * n
        self.values = [0] * n
        free = bytearray(b"\1") * n
        scan = 0
        for b in sorted(range(m), key=lambda i: -len(buckets[i])):
            hashes = [h for h, _ in buckets[b]]
            d = 0
            if len(hashes) == 1:
                scan = free.index(1, scan)
                d = -scan - 1
            while True:
                at = {self._place(h, d) for h in hashes}
                if len(at) == len(hashes) and all(free[x] for x in at):
                    break
                d += 1
            self.shift[b] = d
            for h, key in buckets[b]:
                x = self._place(h, d)
                free[x], self.keys[x], self.values[x] = 0, key, keys[key]

    def _place(self, h: int, d: int) -> int:
        return -d - 1 if d < 0 else ((h >> 20) * (2 * d + 1) + (h >> 7) + d * d) % 0xFFFFFFFB % self.n

    def get(self, key: bytes) -> int | None:
        h = xxhash.xxh3_64_intdigest(key)
        x = self._place(h, self.shift[h % self.m])
        return self.values[x] if self.keys[x] == key else None


class Codec:
    """Encodes as the ranks say: in each pre-token the pair of lowest rank is merged first, the leftmost of equals."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.whole = PerfectHash(ranks)
        self.split = regex.compile(pattern).findall
        self.bytes = {i: b for b, i in ranks.items()}
        self.seen = _Seen(self)

    def merged(self, word: bytes) -> tuple[int, ...]:
        """Parts are a linked list over byte positions; a heap holds the pairs by rank, stale ones are passed over."""
        n, rank = len(word), self.ranks.get
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := rank(word[i:i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, end = heapq.heappop(heap)
            j = after[i]
            if j < 0 or j >= n or after[j] != end:  # a part has since been merged
                continue
            after[i], after[j] = end, -1
            if end < n:
                before[end] = i
                if (r := rank(word[i:after[end]])) is not None:
                    heapq.heappush(heap, (r, i, after[end]))
            if (k := before[i]) >= 0 and (r := rank(word[k:end])) is not None:
                heapq.heappush(heap, (r, k, end))
        ids, i = [], 0
        while i < n:
            ids.append(self.ranks[word[i:after[i]]])
            i = after[i]
        return tuple(ids)

    def encode(self, text: str) -> np.ndarray:
        return np.fromiter(chain.from_iterable(map(self.seen.__getitem__, self.split(text))), np.int32)

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids.tolist()))


class _Seen(dict):
    """Ids of the pre-tokens met so far, bounded; what is new goes through the two tiers."""

    def __init__(self, codec: Codec):
        super().__init__()
        self.codec = codec

    def __missing__(self, token: str) -> tuple[int, ...]:
        raw = token.encode()
        whole = self.codec.whole.get(raw)
        ids = self.codec.merged(raw) if whole is None else (whole,)
        if len(raw) <= 64:
            if len(self) >= _REMEMBERED:
                self.clear()
            self[token] = ids
        return ids


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    lines = Path(path).read_bytes().splitlines()
    return Codec({base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x)}, pattern)


def _run(path: str, pattern: str):
    def run(batches):
        own = codec(path, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                ids = [own.encode(t or "") for t in part.column(1).to_pylist()]
                ends = pa.array(np.cumsum([0, *map(len, ids)]), pa.int32())
                flat = pa.array(np.concatenate([*ids, np.zeros(0, np.int32)]), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.ListArray.from_arrays(ends, flat), pa.array([own.decode(x) for x in ids], pa.binary())],
                    ["doc_id", "ids", "decoded"])
    return run


def encode_decode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids, decoded``: the ids of each whole text, and the bytes that they stand for.

    Special tokens' strings are ordinary text. Null and empty texts have no ids. Rows are coded one by one: null or
    repeated ids and other columns do not matter. ``path`` is a file of base64 tokens and ranks that holds all single
    bytes, readable on every executor; each match of ``pattern`` is coded by itself.
    """
    prepare(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return texts.mapInArrow(_run(path, pattern), "doc_id long, ids array<int>, decoded binary")
