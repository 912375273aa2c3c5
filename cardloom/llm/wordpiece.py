"""Token counts by greedy longest match.

Method: one automaton pass. The vocabulary is a trie; each node knows how many
longest-match pieces end for certain when the next byte does not continue it
(popped count), and the node where matching then goes on (failure link). The
count is a sum of popped counts: no piece is built and no byte is read twice.

Cases: a null or empty text has no words and no tokens. A word with a byte that
no piece covers counts as one unknown token. A special token's text counts as
one. Repeated rows are counted each for itself; texts are read whole, other
columns of the input are left out, an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardloom.llm.bytelevel import read_vocabulary
from cardloom.llm.common import Shared, map_rows

#: Words of which a task keeps the count, and the longest one kept.
KEPT_WORDS, KEPT_CHARS = 300_000, 40


class PieceAutomaton:
    """Trie with failure links; an edge is keyed by node * 256 + byte."""

    def __init__(self, pieces: Iterable[bytes]):
        self.edges: dict[int, int] = {}
        final: set[int] = set()
        by_depth: list[list[tuple[int, int, int]]] = []
        nodes = 1
        for piece in pieces:
            at = 0
            for depth, byte in enumerate(piece):
                to = self.edges.get(at << 8 | byte)
                if to is None:
                    to = self.edges[at << 8 | byte] = nodes
                    nodes += 1
                    if depth == len(by_depth):
                        by_depth.append([])
                    by_depth[depth].append((at, byte, to))
                at = to
            if at:
                final.add(at)
        self.link = [-1] * nodes  # -1: the rest can't be matched
        self.popped = [0] * nodes
        for level in by_depth:
            for parent, byte, node in level:
                if node in final:
                    self.link[node], self.popped[node] = 0, 1
                    continue
                at, count = self.link[parent], self.popped[parent]
                while at >= 0 and at << 8 | byte not in self.edges:
                    count += self.popped[at]
                    at = self.link[at]
                if at >= 0:
                    self.link[node], self.popped[node] = self.edges[at << 8 | byte], count

    def count(self, word: bytes) -> int | None:
        """Number of pieces of a word, None if some byte has no piece."""
        step, link, popped = self.edges.get, self.link, self.popped
        at = total = 0
        for byte in word:
            while (to := step(at << 8 | byte)) is None:
                total += popped[at]
                at = link[at]
                if at < 0:
                    return None
            at = to
        while at:
            total += popped[at]
            at = link[at]
            if at < 0:
                return None
        return total


def token_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``n_words``, ``n_tokens``, ``n_unknown long`` of each row.

    ``path`` names a byte-level vocabulary: its pieces with a leading space begin
    a word, the others continue one.
    """
    shared = Shared(docs.sparkSession, read_vocabulary(path))
    source = docs.select(F.col(id_col), F.col(text_col))

    def factory():
        vocabulary = shared.value
        special = set(vocabulary.special.values())
        automaton = shared.built("pieces", lambda v: PieceAutomaton(t for i, t in enumerate(v.tokens) if i not in special))
        cut, kept = vocabulary.cutter().words, {}

        def row(key, text):
            words = cut(text) if text else []
            total = unknown = 0
            for word in words:
                n = kept.get(word)
                if n is None:
                    n = 1 if isinstance(word, int) else automaton.count(word.encode())
                    n = 0 if n is None else n
                    if len(kept) >= KEPT_WORDS:
                        kept.clear()
                    if isinstance(word, int) or len(word) <= KEPT_CHARS:
                        kept[word] = n
                total += n or 1
                unknown += not n
            return key, len(words), total, unknown

        return row

    return map_rows(source, factory, f"`{id_col}` {source.dtypes[0][1]}, n_words long, n_tokens long, n_unknown long")
