from __future__ import annotations

import hashlib
import itertools
import random
import re
import time

import numpy as np

from cardloom.llm import pii, tagger

# the patterns as they are stated
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def stated(text):
    digits = lambda t: re.sub("[^0-9]", "", t)
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    for m in CARD.finditer(text):
        d = digits(m.group())
        total = sum(int(c) if i % 2 == 0 else sum(map(int, str(2 * int(c)))) for i, c in enumerate(reversed(d)))
        if 16 <= len(d) <= 19 and total % 10 == 0:
            out.append(("card", *m.span()))
    return out + [("phone", *m.span()) for m in PHONE.finditer(text) if 8 <= len(digits(m.group())) <= 15]


def test_base_spans_are_the_stated_patterns():
    rng = random.Random(4)
    pieces = ["a", "B.c", "@", "x@y", ".z", "@d.e", "-", "%+", "12", "1.2", ".3.4", "300", "0001.2.3.4.5", " ", "  ", "+1", "(", ")", "é", "\n", "4111 1111-1111", "1111", "4012888888881881", "+33 6 12", " 34 56 78", "９", "٣"]
    for _ in range(6000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 14)))
        assert pii.base_spans(text) == stated(text), text
    assert pii.base_spans("a@b.c@d.e f@g") == [("email", 0, 5)]


def test_long_texts_are_linear():
    n = 300_000
    for text in ("a" * n, "1" * n, "1 " * n, "1." * n, "@" * n, "a@" * n, "+1" * n, "+1" + " " * n, "a.b@c." * n, "1-" * n + "x", "(at)" * n, "é" * n):
        start = time.perf_counter()
        pii.base_spans(text)
        assert time.perf_counter() - start < 8, text[:10]
        assert sum(1 for _ in pii.window_starts(text)) <= len(text) // pii.STRIDE + 1


def test_gradient():
    rng = np.random.default_rng(0)
    t = tagger.Tagger.new()
    t.w = {n: w.astype(np.float64) for n, w in t.w.items()}
    ids = rng.integers(0, tagger.SYMBOLS, (3, 12)).astype(np.uint8)
    tags = np.zeros((3, 12), dtype=np.uint8)
    tags[0, 3:6], tags[1, :2], tags[2, 11] = (1, 2, 2), (5, 6), 7
    _, grads = t.gradient(ids, tags)
    for name, at in (("inputs", (0, ids[0, 3], 5)), ("inputs", (1, ids[1, 1], 30)), ("inputs", (1, ids[2, 11], 44)), ("again", (0, 3, 7)), ("again", (1, 11, 40)), ("out", (17, 8)), ("out", (2, 1)), ("bias", (3,)), ("moves", (0, 1)), ("moves", (6, 0))):
        w, old = t.w[name], t.w[name][at]
        w[at] = old + 1e-3
        up = t.gradient(ids, tags)[0]
        w[at] = old - 1e-3
        down = t.gradient(ids, tags)[0]
        w[at] = old
        assert abs((up - down) / 2e-3 - grads[name][at]) < 1e-3, name


def test_best_tags_against_all_taggings():
    rng = np.random.default_rng(1)
    t = tagger.Tagger.new(3)
    t.w = {n: w * 4 for n, w in t.w.items()}
    ids = rng.integers(0, tagger.SYMBOLS, (2, 4)).astype(np.uint8)
    got, likely = t.best(ids)
    scores, _ = t._emissions(t._run(ids)[0])
    for row in range(2):
        paths = {}
        for path in itertools.product(range(tagger.TAGS), repeat=4):
            if all(p % 2 or not p or (i and path[i - 1] in (p, p - 1)) for i, p in enumerate(path)):
                paths[path] = sum(float(scores[i, row, p]) for i, p in enumerate(path)) + sum(float(t.w["moves"][a, b]) for a, b in zip(path, path[1:]))
        assert tuple(got[row]) == max(paths, key=paths.get)
        total = sum(np.exp(v) for v in paths.values())
        for i in range(4):
            assert abs(sum(np.exp(v) for p, v in paths.items() if p[i] == got[row][i]) / total - likely[row][i]) < 1e-3


def test_reconciled_against_all_choices():
    rng = random.Random(6)
    for _ in range(200):
        found = []
        for _ in range(rng.randint(0, 8)):
            s = rng.randint(0, 20)
            found.append((rng.choice(pii.KINDS), s, s + rng.randint(1, 8), rng.random()))
        best = max(
            sum(p for *_, p in c) for n in range(len(found) + 1) for c in itertools.combinations(found, n)
            if all(a[2] <= b[1] or b[2] <= a[1] for a, b in itertools.combinations(c, 2))
        )
        got = pii.reconciled(found)
        assert abs(sum(max(p for k, a, b, p in found if (k, a, b) == span) for span in got) - best) < 1e-9
        assert all(a[2] <= b[1] for a, b in zip(got, got[1:]))


def _texts(n, seed):
    rng = random.Random(seed)
    words = "the of and to in is was for on with as by at from that this which were are an".split()
    out = []
    for i in range(n):
        text = [rng.choice(words) for _ in range(rng.randint(5, 60))]
        digits = "".join(rng.choice("123456789") for _ in range(15))
        card = next(digits + d for d in "0123456789" if pii.luhn(digits + d))
        text.insert(rng.randint(0, len(text)), (
            f"{rng.choice(words)}.{i}@mail{i % 9}.example.com", ".".join(str(rng.randint(1, 255)) for _ in range(4)), card, f"+1 ({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)}"
        )[i % 4])
        out.append(" ".join(text))
    return out


def test_learned_spans(spark, docs_of):
    model = pii.fit(docs_of(list(enumerate(_texts(400, 1)))), steps=500)
    held_out = _texts(120, 2)
    base = [pii.base_spans(t) for t in held_out]
    assert [len(b) for b in base] == [1] * 120
    # found without the patterns, and none added beside them
    found = pii.added_spans(model, held_out, [[]] * 120)
    assert sum(f == [("lstm_" + b[0][0], *b[0][1:])] for f, b in zip(found, base)) >= 110
    assert sum(map(len, pii.added_spans(model, held_out, base))) <= 2
    rng = random.Random(3)
    forms = [(t, pii.altered(b[0][0], t[b[0][1] : b[0][2]], rng), b[0][1], b[0][2]) for t, b in zip(held_out, base)]
    texts = [t[:s] + form + t[e:] for t, form, s, e in forms]
    found = pii.added_spans(model, texts, [pii.base_spans(t) for t in texts])
    assert sum((s, s + len(form)) in {f[1:] for f in got} for (_, form, s, _), got in zip(forms, found)) >= 95
    clean = [" ".join(("the of", pii.harmless(rng), "and was", pii.harmless(rng), "of it")) for _ in range(300)]
    assert sum(map(len, pii.added_spans(model, clean, [pii.base_spans(t) for t in clean]))) <= 3

    # windows meet: a span is found wherever it stands
    form = "was.7 (at) mail3.example.com"
    texts = [("to the of in and was for that by " * 9)[i:] + form + " and was for that" * 9 for i in range(90)]
    assert sum(any(t[s:e] == form for _, s, e in f) for t, f in zip(texts, pii.added_spans(model, texts, [[]] * 90))) >= 80

    rows = [(1, None), (2, ""), (None, held_out[0]), (2, held_out[1]), (2, held_out[1]), (3, "no data"), (4, held_out[2] + " the" * 50_000)]
    got = [tuple(r) for r in pii.scan(docs_of(rows), model).collect()]
    assert len(got) == len(rows)
    for key, text in rows:
        spans = pii.base_spans(text or "")
        listed = ",".join(f"{k}:{s}:{e}" for k, s, e in spans)
        mine = [r for r in got if r[0] == key and r[6] == hashlib.sha256(listed.encode()).hexdigest()]
        assert mine and all(r[1:5] == tuple(sum(s[0] == k for s in spans) for k in pii.KINDS) and r[7].startswith(listed) for r in mine)
    assert pii.scan(docs_of([]), model).count() == 0


def test_nothing_to_learn_from(docs_of):
    for rows in ([], [(1, "no data"), (None, "a@b.cd")], [(1, "a@b.cd"), (1, "+1 234 567 89")]):
        assert pii.fit(docs_of(rows), steps=1) is None
    assert [r.spans for r in pii.scan(docs_of([(1, "x a@b.cd")]), None).collect()] == ["email:2:8"]
