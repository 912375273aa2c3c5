"""Byte-level vocabularies: reading, and cutting texts before they are encoded."""

from __future__ import annotations

import json
import os
import re
import unicodedata
from dataclasses import dataclass

import regex

#: A vocabulary is sent to every executor; larger files are refused.
MAX_FILE_BYTES = 64 << 20


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the files: printable Latin-1 for itself, the others from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


@dataclass(frozen=True)
class Vocabulary:
    """``tokens[i]``: bytes of id i; ``pair``: id that two ids merge into; ``special``: ids of texts found before cutting."""

    tokens: list[bytes]
    merges: list[tuple[int, int]]
    special: dict[str, int]
    unknown: str

    def cutter(self):
        return Cutter(self)


def read_vocabulary(path: str) -> Vocabulary:
    """Byte-level BPE file whose ids follow the order of its merges."""
    if os.path.getsize(path) > MAX_FILE_BYTES:
        raise ValueError(f"{path} is larger than {MAX_FILE_BYTES} bytes")
    with open(path, encoding="utf-8") as file:
        data = json.load(file)
    letters = byte_letters()
    ids = data["model"]["vocab"]
    special = {t["content"]: t["id"] for t in data.get("added_tokens") or []}
    tokens = [b""] * (1 + max([*ids.values(), *special.values()]))
    for text, number in ids.items():
        tokens[number] = bytes(letters[c] for c in text)
    for text, number in special.items():
        tokens[number] = text.encode()
    pairs = [m if isinstance(m, list) else m.split(" ") for m in data["model"]["merges"]]
    return Vocabulary(tokens, [(ids[a], ids[b]) for a, b in pairs], special, _unknown())


def _unknown() -> str:
    """Letters, numbers and spaces of newer Unicode versions than Python's: these files do not know them as such."""
    known = regex.compile(r"[\p{L}\p{N}\s]")
    return "".join(c for c in map(chr, range(0x110000)) if unicodedata.category(c) == "Cn" and known.match(c))


class Cutter:
    """Cuts a text into words; a special token's text stands alone, as its id.

    Texts in Latin letters take a pattern with plain ranges, which says the same
    for them as the general one and is much faster.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.special = vocabulary.special
        self._split = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self._beyond = re.compile("[^\x00-\u024f\u2010-\u2027\u2030-\u203e]").search
        self._latin = re.compile(_words("A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u024f", "0-9\xb2\xb3\xb9\xbc-\xbe", "\t-\r \x85\xa0")).findall
        self._known = regex.compile(_words(r"\p{L}", r"\p{N}", r"\s"))
        self._newer = re.compile(f"[{_ranges(vocabulary.unknown)}]") if vocabulary.unknown else None

    def words(self, text: str) -> list[str | int]:
        if self._split is None or not self._split.search(text):
            return self._plain(text)
        out: list[str | int] = []
        at = 0
        for found in self._split.finditer(text):
            out += self._plain(text[at : found.start()])
            out.append(self.special[found.group()])
            at = found.end()
        return out + self._plain(text[at:])

    def _plain(self, text: str) -> list[str]:
        if text.isascii() or not self._beyond(text):
            return self._latin(text)
        if self._newer and self._newer.search(text):
            # letters that the files take for signs are cut as a sign
            signs = self._newer.sub("\uffff", text)
            return [text[x.start() : x.end()] for x in self._known.finditer(signs)]
        return self._known.findall(text)


def _words(letters: str, numbers: str, spaces: str) -> str:
    """The words of the byte-level format (fixed values) for given classes."""
    return rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{letters}]+| ?[{numbers}]+| ?[^{spaces}{letters}{numbers}]+|[{spaces}]+(?![^{spaces}])|[{spaces}]+"


def _ranges(letters: str) -> str:
    out: list[list[int]] = []
    for c in map(ord, letters):
        if out and out[-1][1] == c - 1:
            out[-1][1] = c
        else:
            out.append([c, c])
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in out)
