"""BPE encoding and decoding.

Method: dynamic programming over prefixes. The encoding of a prefix is the
encoding of a shorter prefix plus one last token, and that token is unique: it
is the suffix match whose pair with the shorter prefix's last token survives the
merge order. An automaton over the vocabulary lists the tokens that end at each
byte; the last token of each prefix is stored, and the ids are read backwards
from the end. The work is linear in the bytes of a word, also for words of
megabytes.

Cases: a null or empty text has no tokens and decodes to an empty text. Repeated
rows are encoded each for itself. Texts are encoded whole. Other columns of the
input are left out, so their names cannot clash. An empty table gives an empty
table.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import ahocorasick
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardloom.llm.bytelevel import Vocabulary, read_vocabulary
from cardloom.llm.common import Shared, map_rows

#: Words of which a task keeps the result, and the longest one kept.
KEPT_WORDS, KEPT_CHARS = 300_000, 40
#: Pairs of tokens whose test a task keeps.
KEPT_PAIRS = 500_000


class Encoded(NamedTuple):
    ids: list[int]
    text: str


class Codec:
    """Encoder and decoder of one vocabulary; built once in a Python worker."""

    def __init__(self, vocabulary: Vocabulary):
        self.tokens = vocabulary.tokens
        self.cut = vocabulary.cutter().words
        special = set(vocabulary.special.values())
        self.merged = {pair: 0 for pair in vocabulary.merges}
        self.halves: dict[int, tuple[int, int]] = {}
        number = {t: i for i, t in enumerate(self.tokens) if i not in special}
        for a, b in vocabulary.merges:
            whole = number[self.tokens[a] + self.tokens[b]]
            self.merged[a, b] = whole
            self.halves.setdefault(whole, (a, b))
        self.single = {t[0]: i for t, i in number.items() if len(t) == 1}
        self.automaton = ahocorasick.Automaton()
        for t, i in number.items():
            self.automaton.add_word(t.decode("latin-1"), (len(t), i))
        self.automaton.make_automaton()
        self.whole = {t.decode("latin-1"): [i] for t, i in number.items() if i not in self.halves or self._stands(i)}
        self.fits: dict[int, bool] = {}
        self.kept: dict[str, list[int]] = {}

    def _stands(self, token: int) -> bool:
        """Whether a token's own bytes are encoded as this token."""
        return self._compatible(*self.halves[token], upto=token)

    def _compatible(self, left: int, right: int, upto: int | None = None) -> bool:
        """Whether two tokens stay side by side: no earlier merge crosses the border between them.

        The merges that made both tokens are undone from the latest to the
        earliest; a pair that faces each other at the border at some moment must
        not merge before the one undone last.
        """
        limit = upto if upto is not None else len(self.tokens)
        while True:
            found = self.merged.get((left, right))
            if found is not None and found < limit:
                return False
            # the id grows with the rank of the merge, so the larger one came later
            if left in self.halves and (left > right or right not in self.halves):
                limit = left
                left = self.halves[left][1]
            elif right in self.halves:
                limit = right + 1
                right = self.halves[right][0]
            else:
                return True

    def _word(self, word: str) -> list[int]:
        data = word if word.isascii() else word.encode().decode("latin-1")  # a letter for each byte
        if (one := self.whole.get(data)) is not None:
            return one
        size = len(data) + 1
        last, begin, fits = [-1] * size, [0] * size, self.fits
        for end, (length, token) in self.automaton.iter(data):
            end += 1
            if last[end] >= 0:
                continue  # the last token of a prefix is unique
            start = end - length
            if start:
                before = last[start]
                if before < 0:
                    continue
                ok = fits.get(pair := before << 32 | token)
                if ok is None:
                    if len(fits) >= KEPT_PAIRS:
                        fits.clear()
                    ok = fits[pair] = self._compatible(before, token)
                if not ok:
                    continue
            last[end], begin[end] = token, start
        out, at = [], size - 1
        while at:
            out.append(last[at])
            at = begin[at]
        out.reverse()
        return out

    def encode(self, text: str) -> list[int]:
        kept, out = self.kept, []
        for word in self.cut(text):
            ids = kept.get(word)
            if ids is None:
                if isinstance(word, int):
                    ids = [word]
                else:
                    ids = self._word(word)
                    if len(word) <= KEPT_CHARS:
                        if len(kept) >= KEPT_WORDS:
                            kept.clear()
                        kept[word] = ids
            out += ids
        return out

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.tokens.__getitem__, ids)).decode("utf-8", "replace")


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``ids array<int>``, ``n_tokens long`` of each row; ``path`` names a byte-level BPE file."""
    shared = Shared(docs.sparkSession, read_vocabulary(path))
    source = docs.select(F.col(id_col), F.col(text_col))

    def factory():
        c = shared.built("codec", Codec)

        def row(key, text):
            ids = c.encode(text or "")
            return key, ids, len(ids)

        return row

    return map_rows(source, factory, f"`{id_col}` {source.dtypes[0][1]}, ids array<int>, n_tokens long")


def encode_and_decode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``ids array<int>``, ``n_tokens long``, ``decoded_sha256 string`` of each row: the ids, and the digest of the text decoded from them."""
    shared = Shared(docs.sparkSession, read_vocabulary(path))
    source = docs.select(F.col(id_col), F.col(text_col))

    def factory():
        c = shared.built("codec", Codec)

        def row(key, text):
            ids = c.encode(text or "")
            return key, ids, len(ids), hashlib.sha256(c.decode(ids).encode()).hexdigest()

        return row

    return map_rows(source, factory, f"`{id_col}` {source.dtypes[0][1]}, ids array<int>, n_tokens long, decoded_sha256 string")


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``id_col``, ``text string`` of each row; a null list gives an empty text."""
    shared = Shared(encoded.sparkSession, read_vocabulary(path))
    source = encoded.select(F.col(id_col), F.col(ids_col))

    def factory():
        c = shared.built("codec", Codec)
        return lambda key, ids: (key, c.decode(ids or []))

    return map_rows(source, factory, f"`{id_col}` {source.dtypes[0][1]}, text string")


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Count and digests of ids and of the text decoded from them, in one pass.

    Gives ``id_col``, ``n_tokens long``, ``ids_sha256``, ``decoded_sha256 string``.
    """
    shared = Shared(docs.sparkSession, read_vocabulary(path))
    source = docs.select(F.col(id_col), F.col(text_col))

    def factory():
        c = shared.built("codec", Codec)
        names = [str(i) for i in range(len(c.tokens))]

        def row(key, text):
            ids = c.encode(text or "")
            listed = ",".join(map(names.__getitem__, ids)).encode()
            return key, len(ids), hashlib.sha256(listed).hexdigest(), hashlib.sha256(c.decode(ids).encode()).hexdigest()

        return row

    return map_rows(source, factory, f"`{id_col}` {source.dtypes[0][1]}, n_tokens long, ids_sha256 string, decoded_sha256 string")
