"""Personal data in texts: patterns, and a tagger of characters learned from their spans.

Method: four patterns give base spans. A bidirectional LSTM with CRF transitions
(``tagger``) learns from windows around the base spans of a bounded sample of
rows, and around altered forms of them that the patterns don't know (spelled-out
signs, other separators, no country sign), each labelled with its span; windows
with digits and without spans, and made-up dates, prices and versions, are what is
none. Every text is then read in windows of ``WINDOW`` characters, each of which
overlaps the next by half. A window is decoded where it holds a digit or an at
sign, also a spelled-out one: every personal datum of these kinds holds one. Spans
cut by a window's edge are left to the neighbour. All windows' spans of a text are
reconciled at once: of those that meet, the set with the greatest sum of
probabilities stays (weighted intervals), so each added span is decided by the
whole text. An added span meets no base span, and passes a check of its kind:
digits, Luhn sum, parts of an address.

Added kinds are named ``lstm_email`` and so on and come after the base kinds.

Cases: a null or empty text has no spans. Texts are read whole; positions count
code points, ends are exclusive. Repeated rows are scanned each for itself; in the
sample an id stands once, with its largest text. Null ids teach nothing. With
fewer than ``LEAST`` labelled windows nothing is learned and no span added. Other
columns are left out. An empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardloom.llm.common import CHUNK, Shared, arrow_schema, map_batches, map_rows, python_ready, record_batch
from cardloom.llm.tagger import KINDS, STEPS, WINDOW, Tagger, symbols, train

Span = tuple[str, int, int]

# fixed values: the base patterns. A match can only begin where its first run of characters begins, and runs aren't given back, so all are linear
LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9]++(?:[\x20-][0-9]++)*+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

#: Most rows, and spans of a row, that are learned from; altered forms of a span, made-up numbers of a row; least windows with a span.
SAMPLE, SPANS_A_ROW, ALTERED, HARMLESS, LEAST = 3000, 3, 3, 3, 40
STRIDE = WINDOW // 2
#: Least probability of every character of an added span.
SURE = 0.5
#: What every span of these kinds holds at least one of.
SIGN = re.compile(r"[0-9@]|[(\[]\x20?at\x20?[)\]]", re.I)
ADDED = tuple(f"lstm_{k}" for k in KINDS)
#: Windows that are decoded at once.
TOGETHER = 512


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _byte(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def _emails(text: str) -> Iterator[tuple[int, int]]:
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and LOCAL.match(text[start - 1]):
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            end = found.end()
            yield start, end
        # what stands before this sign can't begin a later match
        end = max(end, at + 1)
        at = text.find("@", end)


def base_spans(text: str) -> list[Span]:
    """Base spans by kind, then start."""
    out: list[Span] = [("email", *s) for s in _emails(text)]
    if not any(c in text for c in "0123456789"):
        return out
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(_byte(p) for p in m.group().split("."))]
    out += [("card", *m.span()) for m in CARD.finditer(text) if m.end() - m.start() >= 16 and 16 <= len(d := _digits(m.group())) <= 19 and luhn(d)]
    out += [("phone", *m.span()) for m in PHONE.finditer(text) if 8 <= len(_digits(m.group())) <= 15]
    return out


# learning ------------------------------------------------------------------


def altered(kind: str, text: str, rng: random.Random) -> str:
    """A form of a base span that its pattern does not know, or knows in part only."""
    if kind == "email":
        local, domain = text.split("@", 1)
        at = rng.choice((" (at) ", "(at)", " [at] ", "[at]", " @ "))
        return local + at + (domain.replace(".", rng.choice((" (dot) ", "[.]", "."))) if "@" not in at else domain)
    if kind == "ip":
        return text.replace(".", rng.choice(("[.]", "(.)", " . ")))
    digits = _digits(text)
    if kind == "card":
        if rng.random() < 0.4:
            digits = "3" + rng.choice("47") + digits[2:14]
            digits += next(d for d in "0123456789" if luhn(digits + d))
            parts = (digits[:4], digits[4:10], digits[10:])
        else:
            parts = tuple(digits[i : i + 4] for i in range(0, len(digits), 4))
        return rng.choice((".", "  ", "/", "_")).join(parts) if len(digits) != 15 or rng.random() < 0.5 else rng.choice(("", " ", "-")).join(parts)
    local = digits[-10:]
    form = rng.choice(("({}) {}-{}", "{}-{}-{}", "{}.{}.{}", "{} {} {}", "{}/{}-{}", "00{} {} {}"))
    return form.format(local[:3], local[3:6], local[6:])


def harmless(rng: random.Random) -> str:
    """A number that is none of the kinds."""
    y, m, d, n = rng.randint(1900, 2099), rng.randint(1, 12), rng.randint(1, 28), rng.randint(0, 99999)
    return rng.choice((
        f"{y}-{m:02}-{d:02}", f"{d:02}.{m:02}.{y}", f"{d}/{m}/{y}", f"{y}-{m:02}-{d:02} {m:02}:{d:02}", f"{y}-{y + d}", f"{m}.{d}.{n % 20}", f"v{m}.{d}", f"${n},{100 + d * 10}.{d:02}",
        f"{n}", f"{n / 100:.2f}", f"{m} {d} {n}", f"no. {n}-{y}", f"{m}:{d:02}", f"{100 + d},{100 + m},{100 + n % 900}", f"@user{n}", f"{n % 100} %", f"{y}{m:02}{d:02}{n:05}", f"{n}-{n}-{d}",
    ))


def _shaped(text: str) -> list[Span]:
    """Base spans, and cards whose sum is wrong: a tagger of characters can't learn sums, so they are checked afterwards."""
    cards = [("card", *m.span()) for m in CARD.finditer(text) if 16 <= len(_digits(m.group())) <= 19]
    return [s for s in base_spans(text) if s[0] != "card"] + cards


def examples(text: str, seed: str) -> list[tuple[bytes, bytes]]:
    """Windows of a text as symbols and tags: with base spans, altered spans, and numbers that are no span."""
    rng = random.Random(seed)
    spans: list[Span] = []
    for span in sorted(_shaped(text), key=lambda s: (s[1], -s[2])):
        if not spans or span[1] >= spans[-1][2]:
            spans.append(span)
    signs = [m.start() for m in SIGN.finditer(text)]
    out = []
    chosen = rng.sample(spans, min(len(spans), SPANS_A_ROW))
    for kind, start, end in chosen:
        for form in (text[start:end], *(altered(kind, text[start:end], rng) for _ in range(ALTERED))):
            out.append(_example(text, start, end, form, kind, spans, rng))
    covered = _covered(spans)
    free = [p for p in rng.sample(signs, min(len(signs), 20)) if not _meets(covered, p - WINDOW, p + WINDOW)]
    for p in free[:1]:
        out.append(_example(text, p, p, "", None, spans, rng))
    for _ in range(HARMLESS):
        at = rng.randint(0, len(text))
        if not _meets(covered, at - 1, at + 1):
            out.append(_example(text, at, at, f" {harmless(rng)} ", None, spans, rng))
    return out


def _example(text: str, start: int, end: int, form: str, kind: str | None, spans: list[Span], rng: random.Random) -> tuple[bytes, bytes]:
    """A window of ``text`` in which ``form`` stands for [start, end), at a place of chance."""
    before = rng.randint(1, max(1, WINDOW - len(form) - 1))
    a, b = max(0, start - before), min(len(text), end + WINDOW)
    piece = text[a:start] + form + text[end:b]
    tags = np.zeros(len(piece), dtype=np.uint8)
    marked = [(kind, start - a, start - a + len(form))] if kind else []
    for k, s, e in spans:
        if e <= start or s >= end:
            shift = -a if e <= start else len(form) - (end - start) - a
            marked.append((k, max(0, s + shift), min(len(piece), e + shift)))
    for k, s, e in marked:
        if s < e:
            tags[s:e] = 2 + 2 * KINDS.index(k)
            tags[s] = 1 + 2 * KINDS.index(k)
    ids = np.zeros(WINDOW, dtype=np.uint8)
    full = np.zeros(WINDOW, dtype=np.uint8)
    n = min(WINDOW, len(piece))
    ids[:n], full[:n] = symbols(piece)[:n], tags[:n]
    return ids.tobytes(), full.tobytes()


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", steps: int = STEPS) -> Tagger | None:
    """Tagger learned from at most ``SAMPLE`` rows with a digit or at sign, those with the smallest hash of their id."""
    read = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).where(F.col("doc_id").isNotNull() & F.col("text").rlike("[0-9@]"))
    known = read.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
    # at most ``SAMPLE`` ids
    texts = read.join(F.broadcast(known), "doc_id").groupBy("doc_id").agg(F.max("text").alias("text"))

    def row(key, text):
        found = examples(text, str(key))
        return key, b"".join(i for i, _ in found), b"".join(t for _, t in found)

    windows = map_rows(texts, lambda: row, f"doc_id {dict(texts.dtypes)['doc_id']}, ids binary, tags binary")

    def learn(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("doc_id")
        ids, tags = (np.frombuffer(b"".join(rows[c]), dtype=np.uint8).reshape(-1, WINDOW) for c in ("ids", "tags"))
        if (tags.any(axis=1)).sum() < LEAST:
            return pd.DataFrame({"tagger": pd.Series([], dtype=object)})
        return pd.DataFrame({"tagger": [train(ids, tags, steps).to_bytes()]})

    python_ready(docs.sparkSession)
    # one task learns from the bounded windows of the sample
    found = windows.groupBy(F.lit("all").alias("all")).applyInPandas(learn, "tagger binary").collect()
    return Tagger.from_bytes(found[0].tagger) if found else None


# finding -------------------------------------------------------------------


def window_starts(text: str) -> list[int]:
    """Starts of the windows that hold a sign; each sign stands in the two windows over its half-window."""
    found: set[int] = set()
    at = 0
    while m := SIGN.search(text, at):
        k = m.start() // STRIDE
        found.update(i for i in (k - 1, k) if i >= 0)
        at = max(m.end(), (k + 1) * STRIDE)  # what follows in this half-window is in the same windows
    return [k * STRIDE for k in sorted(found)]


def proposals(start: int, length: int, tags: np.ndarray, likely: np.ndarray) -> Iterator[tuple[str, int, int, float]]:
    """Spans of one window's tags that its edges do not cut, with their probability."""
    n = min(WINDOW, length - start)
    i = 0
    while i < n:
        if not tags[i]:
            i += 1
            continue
        j = i + 1
        while j < n and tags[j] and tags[j] % 2 == 0:
            j += 1
        if (i > 0 or start == 0) and (j < n or start + n == length):
            yield KINDS[(tags[i] - 1) // 2], start + i, start + j, float(likely[i:j].min())
        i = j


def plausible(kind: str, text: str) -> bool:
    digits = _digits(text)
    if kind == "email":
        return bool(re.fullmatch(r"\S+?\x20?(?:@|[(\[]\x20?at\x20?[)\]])\x20?[^\s@]+(?:\x20?(?:[(\[]?\.[)\]]?|[(\[]dot[)\]])\x20?[^\s@]+)+", text, re.I))
    if kind == "ip":
        parts = re.findall("[0-9]+", text)
        return len(parts) == 4 and all(_byte(p) for p in parts) and not re.search(r"[^0-9.()\[\]\x20]", text)
    if re.search(r"[^0-9+().\x20/_-]", text) or text[-1:] in " -./_(":
        return False
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits) and len(set(digits)) > 2
    return 8 <= len(digits) <= 15 and len(re.findall("[0-9]+", text)) > 1 and not re.match(r"(?:1[89]|20)[0-9]{2}[-./][0-9]|[0-9]{1,2}[-./][0-9]{1,2}[-./](?:1[89]|20)[0-9]{2}", text)


def reconciled(found: list[tuple[str, int, int, float]]) -> list[Span]:
    """The spans, no two of which meet, with the greatest sum of probabilities; of equal sums the one with the earlier spans."""
    best: dict[tuple[int, int, str], float] = {}
    for kind, s, e, p in found:
        best[s, e, kind] = max(p, best.get((s, e, kind), 0.0))
    items = sorted(best, key=lambda k: (k[1], k[0], k[2]))
    ends = [e for _, e, _ in items]
    total, taken = [0.0], [False]
    before = np.searchsorted(ends, [s for s, _, _ in items], side="right")
    for i, item in enumerate(items):
        with_it = best[item] + total[min(int(before[i]), i)]
        taken.append(with_it > total[-1])
        total.append(max(with_it, total[-1]))
    out, i = [], len(items)
    while i:
        if taken[i]:
            s, e, kind = items[i - 1]
            out.append((kind, s, e))
            i = min(int(before[i - 1]), i - 1)
        else:
            i -= 1
    return out[::-1]


def added_spans(tagger: Tagger, texts: list[str], base: list[list[Span]]) -> list[list[Span]]:
    """Spans that the tagger adds to each text; windows of all texts are decoded together."""
    found: list[list[tuple[str, int, int, float]]] = [[] for _ in texts]
    codes: list[np.ndarray | None] = [None] * len(texts)
    waiting: list[tuple[int, int]] = []

    def decode() -> None:
        ids = np.zeros((len(waiting), WINDOW), dtype=np.uint8)
        for r, (t, start) in enumerate(waiting):
            piece = codes[t][start : start + WINDOW]
            ids[r, : len(piece)] = piece
        tags, likely = tagger.best(ids)
        for r, (t, start) in enumerate(waiting):
            if tags[r].any():
                found[t] += proposals(start, len(texts[t]), tags[r], likely[r])
        waiting.clear()

    for t, text in enumerate(texts):
        for start in window_starts(text):
            if codes[t] is None:
                codes[t] = symbols(text)
            waiting.append((t, start))
            if len(waiting) == TOGETHER:
                decode()
    if waiting:
        decode()
    out = []
    for t, text in enumerate(texts):
        covered = _covered(base[t])
        kept = [p for p in found[t] if p[3] >= SURE and not _meets(covered, p[1], p[2]) and plausible(p[0], text[p[1] : p[2]])]
        out.append([(f"lstm_{k}", s, e) for k, s, e in reconciled(kept)])
    return out


def _covered(spans: list[Span]) -> tuple[list[int], list[int]]:
    """Starts and ends of the unions of spans, in order."""
    starts, ends = [], []
    for _, s, e in sorted(spans, key=lambda x: x[1]):
        if ends and s <= ends[-1]:
            ends[-1] = max(ends[-1], e)
        else:
            starts.append(s)
            ends.append(e)
    return starts, ends


def _meets(covered: tuple[list[int], list[int]], start: int, end: int) -> bool:
    starts, ends = covered
    i = int(np.searchsorted(ends, start, side="right"))
    return i < len(starts) and starts[i] < end


def _listed(found: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in found)


def scan(docs: DataFrame, tagger: Tagger | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, counts of the base kinds and of added spans, ``base_sha256`` and ``spans`` of each row."""
    spark = docs.sparkSession
    source = docs.select(F.col(id_col), F.col(text_col))
    shared = Shared(spark, None if tagger is None else tagger.to_bytes())
    schema = f"`{id_col}` {source.dtypes[0][1]}, n_email long, n_ip long, n_card long, n_phone long, n_added long, base_sha256 string, spans string"
    out = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = None if shared.value is None else shared.built("tagger", Tagger.from_bytes)
        for batch in batches:
            for start in range(0, batch.num_rows, CHUNK):
                keys, texts = (c.to_pylist() for c in batch.slice(start, CHUNK).columns)
                texts = [t or "" for t in texts]
                base = [base_spans(t) for t in texts]
                added = [[]] * len(texts) if m is None else added_spans(m, texts, base)
                rows = []
                for key, b, more in zip(keys, base, added, strict=True):
                    n = [sum(s[0] == kind for s in b) for kind in KINDS]
                    every = b + sorted(more, key=lambda s: (ADDED.index(s[0]), s[1]))
                    rows.append((key, *n, len(more), hashlib.sha256(_listed(b).encode()).hexdigest(), _listed(every)))
                yield record_batch(rows, out)

    return map_batches(source, run, schema)
