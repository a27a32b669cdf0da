"""Word-piece token counts by a linear longest-match automaton.

The vocabulary is a trie with two roots: one for pieces that begin a word, one for pieces that go on with it. Every
node has a failure link, the node at which greedy matching goes on when no child fits, and the number of pieces that
are finished ("popped") on the way there. Both are computed once, so a word costs one step per character plus one per
piece: no piece is built and no character read twice, however long the word is.

``n_tokens`` counts every word in full: with the bare word mark before it where no piece begins it, and the bytes of characters
that have no piece. ``n_letters_only`` takes the pieces with letters only, and a word they cannot cover is one unknown token.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._store import prepare

WORD = re.compile(r"\w+|[^\w\s]")
_UNKNOWN = 1 << 40  # added to a word's count, so that one sum gives tokens and unknown words
_MORE = 1 << 80  # and what the unknown words count in full beyond one
_REMEMBERED = 400_000


class LongestMatch:
    """Counts of the greedy longest-match pieces of words. ``begin`` pieces start a word, ``inner`` ones go on.

    ``whole``: a bare mark, one token, comes before a word that no piece begins, and a character without a piece counts
    as many tokens as it has bytes, so every word is covered.
    """

    def __init__(self, begin: Iterable[str], inner: Iterable[str], whole: bool = False):
        self.whole = whole
        self.next: list[dict[str, int]] = [{}, {}]
        final = {}
        for root, pieces in ((0, begin), (1, inner)):
            for piece in pieces:
                node = root
                for c in piece:
                    node = self.next[node].setdefault(c, len(self.next))
                    if node == len(self.next):
                        self.next.append({})
                if node > 1:
                    final[node] = 1
        if whole:
            for c in sorted({c for children in self.next for c in children}):
                node = self.next[1].setdefault(c, len(self.next))
                if node == len(self.next):
                    self.next.append({})
                final.setdefault(node, len(c.encode()))
        self.fail: list[int | None] = [None] * len(self.next)
        self.pops = [0] * len(self.next)
        if whole:
            self.fail[0], self.pops[0] = 1, 1
        level = [0, 1]
        while level:
            below = []
            for u in level:
                for c, v in self.next[u].items():
                    below.append(v)
                    if v in final:
                        self.fail[v], self.pops[v] = 1, final[v]
                        continue
                    z, popped = self.fail[u], self.pops[u]
                    while z is not None and c not in self.next[z]:
                        popped += self.pops[z]
                        z = self.fail[z]
                    if z is not None:
                        self.fail[v], self.pops[v] = self.next[z][c], popped
            level = below

    def count(self, word: str) -> int | None:
        """The number of pieces of ``word``; None if they cannot cover it."""
        node, total, follow, fail, pops = 0, 0, self.next, self.fail, self.pops
        for c in word:
            while (child := follow[node].get(c)) is None:
                if (back := fail[node]) is None:
                    if not self.whole:
                        return None
                    total += len(c.encode())  # no piece has this character
                    child = node
                    break
                total += pops[node]
                node = back
            node = child
        while node > 1:
            if (back := fail[node]) is None:
                return None
            total += pops[node]
            node = back
        return total


class _Counted(dict):
    """Counts of the words met so far; bounded, so a corpus of ever new words does not fill the memory.

    An unknown word's value holds what its whole count has more than one.
    """

    def __init__(self, automaton: LongestMatch, whole: LongestMatch):
        super().__init__()
        self.automaton, self.whole = automaton, whole

    def __missing__(self, word: str) -> int:
        pieces = self.automaton.count(word)
        value = (self.whole.count(word) - 1) * _MORE + _UNKNOWN + 1 if pieces is None else pieces
        if len(word) <= 64:
            if len(self) >= _REMEMBERED:
                self.clear()
            self[word] = value
        return value


@lru_cache(maxsize=2)
def _counted(path: str) -> _Counted:
    """Pieces of a sentence-piece model: those behind its word mark begin words, the others go on with them."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    pieces = [model.id_to_piece(i) for i in ids]
    mark = "▁"
    both = [p[1:] for p in pieces if p[0] == mark and len(p) > 1], [p for p in pieces if mark not in p]
    return _Counted(LongestMatch(*both), LongestMatch(*both, whole=True))


def _count(path: str):
    def run(batches):
        counted = _counted(path)
        for batch in batches:
            words, tokens = [], []
            for text in batch.column(1).to_pylist():
                found = WORD.findall(text or "")
                words.append(len(found))
                tokens.append(sum(map(counted.__getitem__, found)))
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(words, pa.int64()), pa.array([t % _UNKNOWN for t in tokens], pa.int64()),
                pa.array([t % _MORE // _UNKNOWN for t in tokens], pa.int64()),
                pa.array([t % _UNKNOWN + t // _MORE for t in tokens], pa.int64())],
                ["doc_id", "n_words", "n_letters_only", "n_unknown", "n_tokens"])
    return run


def token_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, n_letters_only, n_unknown, n_tokens`` of each row's whole text.

    A word is a run of letters, digits and underscores, or one other character that is not white space. A word that the
    pieces with letters cannot cover counts with the bare mark and byte pieces in ``n_tokens``, and as one, the unknown one, in
    ``n_letters_only``. Null and empty texts have no words. Rows are counted one by one: null or repeated ids and other columns do not matter. ``path`` is the sentence-piece model, readable
    on every executor.
    """
    prepare(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return texts.mapInArrow(_count(path), "doc_id long, n_words long, n_letters_only long, n_unknown long, n_tokens long")
