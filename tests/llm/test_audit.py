from __future__ import annotations

import itertools
import random
import re
from collections import Counter

from cardloom.llm import filteraudit

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def failing(rows):
    """Set of failed filters per (id, text, part) row, by the definitions."""
    out = []
    for key, text, _ in rows:
        text = text or ""
        words = WORD.findall(text)
        out.append({
            name for name, bad in (
                ("A", len(words) < 200), ("B", 100 * len(set(words)) < 50 * len(words)),
                ("C", 100 * len(re.findall("[A-Z]", text)) > 3 * len(text)), ("D", bool(re.search("[#$%&*|]", text))),
                ("E", key is not None and any(k is not None and k < key and (t or "") == text for k, t, _ in rows)),
            ) if bad
        })
    return out


def brute(rows, labels):
    fails = failing(rows)
    good = {k for k, q, _ in labels if q == 1}
    toxic = {k for k, _, t in labels if t == 1}
    want = Counter()
    for part in {p or "" for _, _, p in rows}:
        mine = [(f, k) for f, (k, _, p) in zip(fails, rows) if (p or "") == part]
        table = []
        for order in itertools.permutations("ABCDE"):
            for step, name in enumerate(order):
                before, removed = set(order[:step]), [(f, k) for f, k in mine if name in f and not f & set(order[:step])]
                table.append((
                    "".join(order), step + 1, name, sum(not f & {*before, name} for f, _ in mine), len(removed), sum(name in f and bool(f & before) for f, _ in mine),
                    sum(f == {name} for f, _ in mine), sum(k in good for _, k in removed), sum(k in toxic for _, k in removed),
                ))
        shapley = Counter()
        for row in table:
            shapley[row[2]] += row[4]
        want.update((part, *row[:2], *row[3:], shapley[row[2]]) for row in table)
    return want


def result(docs, labels):
    got = filteraudit.interactions(docs, labels)
    assert got.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    return Counter(tuple(r) for r in got.collect())


def test_against_brute_force(spark, docs_of):
    rng = random.Random(3)
    texts = [" ".join(rng.choice(("ab", "cd", "Ef", "x#y", "ü", f"w{rng.randint(0, 99)}")) for _ in range(rng.choice((0, 5, 180, 199, 200, 230)))) for _ in range(40)]
    texts += ["", None, " \t\n", "a\x0bb\x1cc d", "A" * 3 + "b" * 97, "A" * 4 + "b" * 96, " ".join(f"v{i}" for i in range(260)), "x " * 100_000]
    rows = [(rng.choice((None, *range(60))), rng.choice(texts), rng.choice(("en", "de", "", None))) for _ in range(300)]
    rows += [(7, texts[0], "en")] * 50 + [(None, texts[1], "en")] * 5 + [(i, "the one copy", "fr") for i in range(200, 260)]
    labels = [(rng.choice((None, *range(60))), rng.choice((0, 1, None)), rng.choice((0, 1, None))) for _ in range(90)]
    docs = docs_of(rows, "doc_id long, text string, lang string").withColumnRenamed("to", "digest").withColumnRenamed("rid", "unit")
    frame = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").selectExpr("*", "'x' as lang", "1 as id", "2 as n")
    assert result(docs, frame) == brute(rows, labels)


def test_identities(spark, docs_of):
    rows = [(i, ("A# " * (i % 7) + "word " * (i % 5 * 60)).strip(), ["en", "de"][i % 2]) for i in range(120)]
    got = filteraudit.interactions(docs_of(rows, "doc_id long, text string, lang string"), spark.createDataFrame([], "doc_id long, quality int, toxic int")).collect()
    fails = failing(rows)
    for r in got:
        name, inside = r.filter_order[r.step - 1], [f for f, row in zip(fails, rows) if row[2] == r.part]
        assert r.removed + r.redundant == sum(name in f for f in inside)
        assert (r.good_lost, r.toxic_lost) == (0, 0)
        assert 0 <= r.unique_fails <= r.removed
    assert {(r.part, r.kept) for r in got if r.step == 5} == {(p, sum(not f for f, row in zip(fails, rows) if row[2] == p)) for p in ("en", "de")}


def test_empty_and_clean(spark, docs_of):
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    assert filteraudit.interactions(docs_of([], "doc_id long, text string, lang string"), labels).count() == 0
    clean = result(docs_of([(1, " ".join(f"w{i}" for i in range(200)), None)], "doc_id long, text string, lang string"), labels)
    assert len(clean) == 600 and {row[3:] for row in clean} == {(1, 0, 0, 0, 0, 0, 0)}
