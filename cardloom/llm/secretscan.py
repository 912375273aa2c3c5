"""Secret scans.

Method: three base patterns, and Shannon entropy of sliding windows over
candidate strings. A candidate is a run of key characters; within it the entropy
of each window of ``WINDOW`` characters is kept by incremental counts. The
threshold of a window follows from its own characters: hexadecimal digits,
letters of one case and digits, of both cases and digits, or with separators.
Windows over the threshold join into one span;
identifiers on the allow-list are suppressed. Base spans are cut out of a joined
span, and each piece left that holds a window over the threshold is kept.

Cases: a null or empty text has no spans. Repeated rows are scanned each for
itself, texts whole; positions count code points, ends are exclusive. Other
columns of the input are left out. An empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardloom.llm.common import map_rows

Span = tuple[str, int, int]
KINDS = ("assign", "access", "hex", "entropy")

# fixed values: the base patterns
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_VALUE = 6

WINDOW = 20
#: Least bits per character of a window that is a key; nineteen of twenty windows of random keys of a class, or more, have them.
HEX_BITS, CASE_BITS, MIXED_BITS, KEY_BITS = 3.0, 3.4, 3.65, 3.8
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}")
#: What looks random and is none: UUIDs, paths of words, identifiers of at most 40 characters, counted-up characters.
ALLOWED = (
    re.compile(r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}"),
    re.compile(r"(?:[A-Za-z]*[/_=+-])+[A-Za-z]*"),
    re.compile(r"(?=.{1,40}\Z)[a-z]*(?:[A-Z]+[a-z]{2,})*[A-Z]*[0-9]{0,4}"),
    re.compile(r"[0-9/_=+-]+"),
)
SEPARATORS = "/_=+-"
STRETCH = re.compile(r"[A-Za-z0-9]{20,}")
RISING = "0123456789abcdefghijklmnopqrstuvwxyz"


def base_spans(text: str) -> list[Span]:
    """Base spans in the order of their starts, then of ``KINDS``."""
    out: list[Span] = []
    low = text.lower()
    if any(word in low for word in ("passw", "secret", "token", "api")):
        out += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_VALUE]
    if "AKIA" in text:
        out += [("access", *m.span()) for m in ACCESS.finditer(text)]
    out += [("hex", *m.span()) for m in HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def window_bits(run: str, window: int = WINDOW) -> Iterator[float]:
    """Entropy of each window of ``run``: log2 w - sum(c log2 c) / w, with the sum kept while the window slides."""
    weight = [0.0] + [c * math.log2(c) for c in range(1, window + 1)]
    counts: dict[str, int] = {}
    total = 0.0
    for i, letter in enumerate(run):
        if i >= window:
            # the leaving character first: a count never exceeds the window
            gone = run[i - window]
            c = counts[gone]
            counts[gone] = c - 1
            total += weight[c - 1] - weight[c]
        c = counts.get(letter, 0)
        counts[letter] = c + 1
        total += weight[c + 1] - weight[c]
        if i >= window - 1:
            yield math.log2(window) - total / window


def window_limits(run: str, window: int = WINDOW) -> Iterator[float]:
    """Threshold of each window of ``run`` by its class; a stretch between separators that is allowed by itself has the highest."""
    sign = high = low = high_letter = low_letter = -1  # last places of separators, of letters, and of letters beyond F
    known = {i for m in STRETCH.finditer(run) if _allowed(m.group()) for i in range(m.start(), m.end() - window + 1)} if len(run) > window else ()
    for i, letter in enumerate(run):
        if letter in SEPARATORS:
            sign = i
        elif "A" <= letter <= "Z":
            high = i
            high_letter = i if letter > "F" else high_letter
        elif "a" <= letter <= "z":
            low = i
            low_letter = i if letter > "f" else low_letter
        first = i - window + 1
        if first < 0:
            continue
        if sign >= first or first in known:
            yield KEY_BITS
        elif high >= first and low >= first:
            yield MIXED_BITS
        elif high_letter >= first or low_letter >= first:
            yield CASE_BITS
        else:
            yield HEX_BITS


def entropy_spans(text: str, taken: list[Span]) -> list[Span]:
    out: list[Span] = []
    for found in CANDIDATE.finditer(text):
        run = found.group()
        if _allowed(run):
            continue
        over = [found.start() + i for i, (bits, least) in enumerate(zip(window_bits(run), window_limits(run))) if bits >= least]
        for a, b in _pieces(over, taken):
            part = text[a:b]
            mixed = any(c.isdigit() for c in part) and any(c.isalpha() for c in part)
            if mixed and not _allowed(part.strip(SEPARATORS)):
                out.append(("entropy", a, b))
    return out


def _allowed(run: str) -> bool:
    return any(allowed.fullmatch(run) for allowed in ALLOWED) or run.lower() in RISING * 2


def _pieces(over: list[int], taken: list[Span]) -> Iterator[tuple[int, int]]:
    """Unions of the windows that start at ``over``, without ``taken``: the pieces that hold a whole window."""
    joined: list[list[int]] = []
    for i in over:
        if joined and i <= joined[-1][1]:
            joined[-1][1] = i + WINDOW
        else:
            joined.append([i, i + WINDOW])

    def whole(a: int, b: int) -> bool:
        first = bisect_left(over, a)
        return first < len(over) and over[first] + WINDOW <= b

    at = 0  # both lists are in the order of their starts
    for start, end in joined:
        while at < len(taken) and taken[at][2] <= start:
            at += 1
        for i in range(at, len(taken)):
            _, s, e = taken[i]
            if s >= end:
                break
            if whole(start, s):
                yield start, s
            start = max(start, e)
        if whole(start, end):
            yield start, end


def spans(text: str | None) -> tuple[list[Span], list[Span]]:
    """Base spans, and all spans in the same order."""
    if not text:
        return [], []
    base = base_spans(text)
    return base, sorted(base + entropy_spans(text, base), key=lambda s: (s[1], KINDS.index(s[0])))


def redacted(text: str | None, found: list[Span], mark: str = "[SECRET]") -> str | None:
    """``text`` with each span, or union of spans that overlap, replaced by ``mark``."""
    if not found:
        return text
    out, at, until = [], 0, -1
    for _, start, end in found:
        if start >= until:
            out += [text[at:start], mark]
        until = at = max(until, end)
    return "".join(out) + text[at:]


def _listed(found: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in found)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, counts of the base kinds and of added spans, ``base_sha256`` and ``spans string`` of each row."""
    source = docs.select(F.col(id_col), F.col(text_col))

    def row(key, text):
        base, every = spans(text)
        n = [sum(s[0] == kind for s in every) for kind in KINDS]
        return key, *n, hashlib.sha256(_listed(base).encode()).hexdigest(), _listed(every)

    return map_rows(
        source, lambda: row,
        f"`{id_col}` {source.dtypes[0][1]}, n_assign long, n_access long, n_hex long, n_entropy long, base_sha256 string, spans string",
    )


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """All columns of ``docs``, with the secrets in its text marked; rows without secrets stay as they are."""
    at = docs.columns.index(text_col)

    def row(*values):
        found = spans(values[at])[1]
        return (*values[:at], redacted(values[at], found), *values[at + 1 :]) if found else values

    return map_rows(docs, lambda: row, ", ".join(f"`{n}` {t}" for n, t in docs.dtypes))
