from __future__ import annotations

import hashlib
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from cardloom.llm import bpe, wordpiece
from cardloom.llm.bytelevel import read_vocabulary

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    "", " ", "  a", "a<|endoftext|>b <|endoftext|>", "\n\n  x\t\ty  \r\n", "it's 'S we'LL 12½²", "é" * 50, "中文🎉🎉 ك", " " * 700, "a" * 5000, "ab" * 3000,
    "\x00\x1c\x85 \xa0z", "ꟲ᷀࢏ᷱ \U00016ea0x", "—“quoted”… ™", "x" * 3 + " " * 3 + "y",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def vocabulary():
    return read_vocabulary(PATH)


def mixed_texts(n=600):
    rng = random.Random(3)
    parts = ["the", "ing", " ", "\n", "e", "t", "é", "中", "1", "!", "'s", "zz", "࢏", "\U0001f600", "_", "://", "<|endoftext|>"]
    out = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 30))) for _ in range(n)]
    return out + ["".join(chr(rng.choice([rng.randint(0, 127), rng.randint(0, 0x2FFF), rng.randint(0x10000, 0x1FFFF)])) for _ in range(40)) for _ in range(n // 4)]


def test_same_ids_and_texts_as_the_library(library, vocabulary):
    codec = bpe.Codec(vocabulary)
    for text in ODD + mixed_texts():
        ids = library.encode(text, add_special_tokens=False).ids
        assert codec.encode(text) == ids, text
        assert codec.decode(ids) == library.decode(ids, skip_special_tokens=False), text


def test_frames(spark, docs_of, library):
    rows = list(enumerate(ODD)) + [(100, None), (None, "null id"), (700, ""), (800, "again"), (800, "again")]
    docs = docs_of(rows)
    encoded = bpe.encode(docs, PATH)
    got = sorted(((r.doc_id, tuple(r.ids), r.n_tokens) for r in encoded.collect()), key=str)
    want = [(i, tuple(library.encode(t or "", add_special_tokens=False).ids)) for i, t in rows]
    assert got == sorted(((i, ids, len(ids)) for i, ids in want), key=str)
    texts = sorted(((r.doc_id, r.text) for r in bpe.decode(encoded, PATH).collect()), key=str)
    assert texts == sorted(((i, t or "") for i, t in rows), key=str)
    sha = {r.doc_id: r for r in bpe.round_trip(docs, PATH).collect()}
    for i, ids in want[: len(ODD)]:
        assert sha[i].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert sha[i].decoded_sha256 == hashlib.sha256(dict(rows)[i].encode()).hexdigest()
    assert bpe.encode(docs.limit(0), PATH).count() == 0


def greedy(word: bytes, pieces: set[bytes]) -> int:
    n = at = 0
    while at < len(word):
        at = next(end for end in range(len(word), at, -1) if word[at:end] in pieces)
        n += 1
    return n


def test_token_counts(spark, docs_of, vocabulary):
    rows = list(enumerate(ODD + mixed_texts(150))) + [(9000, None), (1, " ")]
    special = set(vocabulary.special.values())
    pieces = {t for i, t in enumerate(vocabulary.tokens) if i not in special}
    cut = vocabulary.cutter().words
    want = []
    for i, text in rows:
        words = cut(text or "")
        want.append((i, len(words), sum(1 if isinstance(w, int) else greedy(w.encode(), pieces) for w in words), 0))
    got = [tuple(r) for r in wordpiece.token_counts(docs_of(rows), PATH).collect()]
    assert sorted(got) == sorted(want)
    assert wordpiece.token_counts(docs_of(rows).limit(0), PATH).count() == 0


def test_automaton_without_all_bytes():
    pieces = [b"a", b"abc", b"abcde", b"bc", b"d", b"cx"]
    automaton = wordpiece.PieceAutomaton(pieces)
    assert automaton.count(b"abcdx") is None
    assert automaton.count(b"abcd") == 2
    assert automaton.count(b"abcdea") == 2
    assert automaton.count(b"abca") == 2
    assert automaton.count(b"") == 0
    assert automaton.count(b"x") is None
