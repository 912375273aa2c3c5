from __future__ import annotations

import random

import numpy as np
import pytest

from cardloom.llm import ngramjoin, vectors
from cardloom.llm.components import components


def groups(n, linked):
    root = list(range(n))
    links = [0] * n

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(n):
        for j in range(i):
            if linked(i, j):
                links[i] += 1
                links[j] += 1
                a, b = top(i), top(j)
                root[max(a, b)] = min(a, b)
    return [top(i) for i in range(n)], links


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)]
    star = [(1000, i) for i in range(1001, 1300)]
    loops = [(5000, 5000), (5001, 5002), (5002, 5001), (5002, 5001)]
    got = {r.node: r.root for r in components(spark.createDataFrame(chain + star + loops, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 1000 for i in range(1000, 1300)} | {5001: 5001, 5002: 5001}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def shingles(text):
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def jaccard_linked(texts):
    sets = [shingles(t) for t in texts]
    return lambda i, j: bool(sets[i] and sets[j]) and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) - 1e-9


def near_texts():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    texts = []
    for size in (6, 30, 60, 120, 400):
        base = [rng.choice(words) for _ in range(size)]
        for edits in (0, 0, 1, 1, 2, 3, 5, 8, 12):
            other = list(base)
            for _ in range(edits):
                other[rng.randrange(size)] = rng.choice(words)
            texts.append(" ".join(other))
    texts += ["one two", "One  two", "three", None, None, "", "  \n", "a b c d e", "a b c d e f"]
    return texts


def test_ngram_join_against_brute_force(spark, docs_of, monkeypatch):
    texts = near_texts()
    rows = [(500 - i, t) for i, t in enumerate(texts)]
    root, links = groups(len(rows), jaccard_linked(texts))
    low = {}
    for i, r in enumerate(root):
        low[r] = min(low.get(r, 10**9), rows[i][0])
    want = {rows[i][0]: (low[root[i]], links[i], low[root[i]] == rows[i][0]) for i in range(len(rows))}
    # small blocks, so that groups are cut into block pairs
    for size in (ngramjoin.BLOCK_CLASSES, 3):
        monkeypatch.setattr(ngramjoin, "BLOCK_CLASSES", size)
        got = {r.doc_id: (r.class_id, r.n_links, r.kept) for r in ngramjoin.near_duplicates(docs_of(rows)).collect()}
        assert got == want


def test_ngram_join_edge_rows(spark, docs_of):
    same = "a b c d e f g"
    got = ngramjoin.near_duplicates(docs_of([(3, same), (3, same), (None, same), (4, None)])).collect()
    assert sorted((str(r.doc_id), r.class_id, r.n_links) for r in got) == [("3", 3, 2), ("3", 3, 2), ("4", 4, 0), ("None", 3, 2)]
    assert sum(r.kept for r in got) == 2
    assert ngramjoin.near_duplicates(docs_of([])).count() == 0


def test_pruning_table_keeps_the_threshold():
    from math import comb

    for n, least in ngramjoin.least_matches():
        # chance that a pair at the threshold has fewer matches
        assert sum(comb(n, m) * 0.8**m * 0.2 ** (n - m) for m in range(least)) < 1e-6
    assert ngramjoin.least_matches()[-1][1] > 100


def test_signatures_estimate_the_similarity():
    rng = random.Random(1)
    words = [f"x{i}" for i in range(3000)]
    a = [rng.choice(words) for _ in range(1500)]
    b = a[:1200] + [rng.choice(words) for _ in range(300)]
    ga, gb = (ngramjoin.ngrams(" ".join(t)) for t in (a, b))
    true = len(np.intersect1d(ga, gb)) / len(np.union1d(ga, gb))
    assert abs((ngramjoin.signature(ga) == ngramjoin.signature(gb)).mean() - true) < 0.1


def planted_vectors():
    rng = np.random.default_rng(2)
    rows = []
    for group in range(12):
        base = rng.normal(size=16)
        for k in range(12):
            rows.append(((base + rng.normal(size=16) * 0.09 * k), group % 3))
    rows += [(rows[0][0], rows[0][1]), (rows[0][0], 2), (rows[0][0] * 5, rows[0][1])]
    out = [([float(x) for x in v], label) for v, label in rows]
    bad = [(None, 1), ([], 1), ([0.0] * 16, 1), ([float("nan")] * 16, 1), ([None] + [1.0] * 15, 1), ([float("inf")] + [1.0] * 15, 1), (out[0][0], None), (out[0][0], None), (out[0][0][:8], out[0][1])]
    return out, bad


@pytest.mark.parametrize("block", [1024, 7])
def test_vectors_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(vectors, "BLOCK", block)
    monkeypatch.setattr(vectors, "LEAF", min(block, 4))
    good, bad = planted_vectors()
    x = np.array([v for v, _ in good])
    norm = np.linalg.norm(x, axis=1)
    cos = x @ x.T / np.outer(norm, norm)
    assert not (np.abs(cos - 0.93) < 1e-9).any()
    root, links = groups(len(good), lambda i, j: good[i][1] == good[j][1] and cos[i, j] >= 0.93)
    rows = [(i, v, label) for i, (v, label) in enumerate(good + bad)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").selectExpr("*", "1 as rid", "2 as dim", "3 as unit", "4 as links")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in vectors.near_duplicates(frame).collect()}
    want = {i: (links[i], root[i], root[i] == i) for i in range(len(good))}
    assert got == want | {i: (0, i, True) for i in range(len(good), len(rows))}
    assert max(links) > 3


def test_folds_are_projections():
    for dim in (1, 3, 64, 65, 100, 128, 1536):
        m = vectors.folded(np.eye(dim))
        n = min(dim, vectors.FOLD)
        assert np.allclose((m.T @ m)[:n, :n], np.eye(n)) and not m[:, n:].any()


def test_vectors_of_any_length(spark, monkeypatch):
    """Long vectors and many lengths: all have boxes, and the result is that of brute force."""
    monkeypatch.setattr(vectors, "BLOCK", 4)
    monkeypatch.setattr(vectors, "LEAF", 2)
    rng = np.random.default_rng(4)
    rows = []
    for dim in (1536, 65, *range(2, 14)):
        centres = rng.normal(size=(5, dim))
        rows += [(centres[k % 2] + rng.normal(size=dim) * rng.choice((0.05, 0.05, 0.45)), k % 4 // 2) for k in range(16 if dim > 64 else 4)]
    unit = [v / np.linalg.norm(v) for v, _ in rows]
    linked = lambda i, j: len(unit[i]) == len(unit[j]) and rows[i][1] == rows[j][1] and unit[i] @ unit[j] >= 0.93
    root, links = groups(len(rows), linked)
    frame = spark.createDataFrame([(i, v.tolist(), label) for i, (v, label) in enumerate(rows)], "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in vectors.near_duplicates(frame).collect()}
    assert got == {i: (links[i], root[i]) for i in range(len(rows))} and max(links) > 2
    # the axes of long vectors part what is apart
    axes = vectors.principal_axes(frame.selectExpr("size(embedding) as dim", "embedding").rdd.map(lambda r: (r.dim, bytearray(np.array(r.embedding).tobytes()))).toDF("dim int, unit binary"))
    long = np.array([u for u in unit if len(u) == 1536])
    y = vectors._projected(long, axes)
    gaps = np.linalg.norm(y[:, None] - y[None], axis=2)
    assert (gaps <= np.linalg.norm(long[:, None] - long[None], axis=2) + 1e-9).all() and gaps.max() > 0.2


def test_no_vectors(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert vectors.near_duplicates(empty).count() == 0
    odd = spark.createDataFrame([(None, [1.0, 2.0], 1), (None, [1.0, 2.0], 1), (4, [1.0, 2.1], 1)], "vec_id long, embedding array<float>, label int")
    assert sorted((str(r.vec_id), r.n_links, r.component_id, r.kept) for r in vectors.near_duplicates(odd).collect()) == [("4", 2, 4, True), ("None", 2, 4, False), ("None", 2, 4, False)]
