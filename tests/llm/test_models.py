from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from cardloom.llm import language, mixing, quality, queries


def auc(scores):
    good, bad = np.array([s for s, y in scores if y]), np.array([s for s, y in scores if not y])
    return (good[:, None] > bad[None, :]).mean()


def test_quality_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    rows = queries.op9_quality(spark, sf).collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1 for r in rows)
    kept = [(r, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert auc([(r.score, y) for r, y in kept]) > 0.97
    assert np.mean([r.predicted == y for r, y in kept]) > 0.95


def test_interactions_in_linear_time():
    rng = np.random.default_rng(1)
    m = quality.Machine(0.3, rng.normal(size=quality.DIM), rng.normal(size=(quality.DIM, quality.FACTORS)))
    at, x = quality.features("Some words, some more words | and signs ### 12")
    x = x.astype(float)
    pairs = sum(m.factors[at[i]] @ m.factors[at[j]] * x[i] * x[j] for i in range(len(at)) for j in range(i))
    assert np.isclose(m.raw(at, x), 0.3 + m.linear[at] @ x + pairs)


def test_quality_edges(spark, docs_of):
    docs = docs_of([(1, "good text of words"), (2, None), (3, ""), (None, "x " * 50_000), (1, "good text of words"), (4, "### $$$ %%%")])
    labels = spark.createDataFrame([(1, 1), (1, 1), (4, 0), (99, 0), (2, None), (None, 1)], "doc_id long, quality int")
    machine = quality.fit(docs, labels)
    got = quality.scored(docs, machine, ["doc_id"]).collect()
    assert len(got) == 6 and all(0 <= r.score <= 1 for r in got)
    assert machine.score("good text of words") > machine.score("### $$$ %%%")
    assert quality.fit(docs, labels).to_bytes() == machine.to_bytes()
    assert quality.fit(docs, labels.limit(0)) is None
    assert {r.score for r in quality.scored(docs, None, ["doc_id"]).collect()} == {0.5}
    assert quality.scored(docs.limit(0), machine, ["doc_id"]).count() == 0


def test_language_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    rows = queries.op10_language(spark, sf).collect()
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").collect()}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert np.mean([r.lang_pred == langs[r.doc_id] for r in rows if r.held_out]) > 0.97


def test_language_edges(spark, docs_of):
    rows = [(i, "le chat de la maison est dans le jardin " * 3, "fr") for i in range(20)] + [(i, "the cat of the house is in the garden " * 3, "en") for i in range(20, 40)]
    rows += [(50, None, "en"), (51, "123 !!", "fr"), (52, "", None), (None, "the cat", None), (53, "la maison", None), (0, rows[0][1], "fr")]
    docs = docs_of(rows, "doc_id long, text string, lang string")
    model = language.fit(docs)
    got = {r.doc_id: (r.lang_pred, r.score) for r in language.predicted(docs, model, ["doc_id"]).collect()}
    assert got[50] == got[51] == got[52] == ("und", 0.0)
    assert (got[None][0], got[53][0], got[1][0]) == ("en", "fr", "fr")
    assert 0.5 < got[1][1] < 1
    assert language.fit(docs).to_bytes() == model.to_bytes()
    nothing = language.fit(docs.limit(0))
    assert {r.lang_pred for r in language.predicted(docs, nothing, ["doc_id"]).collect()} == {"und"}
    assert language.predicted(docs.limit(0), model, ["doc_id"]).count() == 0


def by_hand(rows):
    """Targets by raising the level until the shares are used up; what is taken by going through each source."""
    import hashlib

    sizes = {}
    for _, source, size in rows:
        sizes[source] = sizes.get(source, 0) + size
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, capped = 1.5 * sum(sizes.values()), set()
    while True:
        free = [s for s in order if s not in capped]
        level = (total - sum(2 * sizes[s] for s in capped)) / max(1, sum(weight[s] for s in free))
        more = {s for s in free if 2 * sizes[s] <= level * weight[s]}
        if not more:
            break
        capped |= more
    target = {s: min(2.0 * sizes[s], level * weight[s]) if sum(sizes.values()) else 0.0 for s in order}
    out = []
    for s in order:
        budget = int(target[s] + 0.5)
        whole, rest = divmod(budget, sizes[s]) if sizes[s] else (0, 0)
        for key, _, size in sorted((r for r in rows if r[1] == s), key=lambda r: (hashlib.md5(str("" if r[0] is None else r[0]).encode()).hexdigest(), r[0] or 0, r[2])):
            take = min(size, rest)
            rest -= take
            out.append((key, size, sizes[s], target[s], whole * size + take))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_mixing_against_brute_force(spark, docs_of, seed):
    rng = random.Random(seed)
    rows = [(i, rng.choice(["b", "a", "a", "a", "é", "\U0001f600", None, "z"]), rng.choice([0, 1, 5, 30])) for i in range(150)] + [(3, "a", 7), (3, "a", 7), (None, "b", 4), (900, "empty", 0)]
    data = [(i, ("\tw \n" * n) if n else rng.choice([None, "", "  "]), s) for i, s, n in rows]
    docs = docs_of(data, "doc_id long, text string, source string")
    got = sorted((tuple(r) for r in mixing.shares(docs).collect()), key=str)
    want = sorted(by_hand(rows), key=str)
    assert [g[:3] + g[4:] for g in got] == [w[:3] + w[4:] for w in want]
    assert np.allclose([g[3] for g in got], [w[3] for w in want])
    mix = mixing.mixed(docs, seed="")
    assert mix.columns == docs.columns
    words = sum(len(r.text.split()) for r in mix.collect())
    assert words == sum(g[4] for g in got)
    assert mixing.shares(docs.limit(0)).count() == 0 and mixing.mixed(docs.limit(0)).count() == 0


def test_language_steps_against_plain_formulas():
    """The steps of the regularised leader and the temperature, coordinate by coordinate."""
    rng = np.random.default_rng(3)
    idf = np.ones(language.BUCKETS)
    rows = []
    for i in range(60):
        y = "abc"[i % 3]
        at = np.sort(rng.choice(12, 4, replace=False)).astype(np.int32)
        at = np.unique(np.concatenate((at, [20 + i % 3])).astype(np.int32))
        x = rng.random(len(at)) + 0.5
        rows.append((at, x / np.sqrt(x @ x), y))
    model = language.train(rows, idf)

    z, n = {}, {}

    def weight(c, b):
        if abs(z.get((c, b), 0.0)) <= language.L1:
            return 0.0
        v = z[c, b]
        return (np.sign(v) * language.L1 - v) / ((language.BETA + np.sqrt(n.get((c, b), 0.0))) / language.ALPHA + language.L2)

    learned = [i for i in range(60) if i % language.KEEP != language.KEEP - 1]
    order = np.random.default_rng(11)
    for _ in range(language.PASSES):
        for i in order.permutation(learned):
            at, x, y = rows[i]
            w = [[weight(c, b) for b in at] for c in range(3)]
            raw = [sum(a * v for a, v in zip(line, x)) for line in w]
            top = max(raw)
            p = [np.exp(r - top) for r in raw]
            p = [v / sum(p) for v in p]
            for c in range(3):
                for k, b in enumerate(at):
                    g = (p[c] - ("abc"[c] == y)) * x[k]
                    before = n.get((c, b), 0.0)
                    z[c, b] = z.get((c, b), 0.0) + g - (np.sqrt(before + g * g) - np.sqrt(before)) / language.ALPHA * w[c][k]
                    n[c, b] = before + g * g
    for c in range(3):
        for b in range(30):
            assert abs(model.weights[c, b] - weight(c, b)) < 1e-9
    assert (model.weights == 0).mean() > 0.99 and model.weights.any()

    kept = [i for i in range(60) if i % language.KEEP == language.KEEP - 1]

    def loss(t):
        other, total = 1 / (len(kept) + 2), 0.0
        for i in kept:
            at, x, y = rows[i]
            logs = np.log(language.softmax(model.weights[:, at] @ x / t))
            k = "abc".index(y)
            total -= (1 - other) * logs[k] + other * (logs.sum() - logs[k]) / 2
        return total

    assert loss(model.temperature) <= min(loss(t) for t in np.exp(np.linspace(np.log(0.05), np.log(20), 400))) + 1e-6
    again = language.Model.from_bytes(model.to_bytes())
    assert (again.weights == model.weights).all() and again.temperature == model.temperature and (again.idf == idf).all()


def test_language_vectors_and_repeated_ids(spark, docs_of):
    texts = ["der Hund und die Katze", "the dog and the cat", "un chien et le chat", "the the the"]
    rows = [(i, texts[i % 4] + f" {'x' * (i % 3)}", ["de", "en", "fr", "en"][i % 4]) for i in range(40)]
    # one id holds most rows, and a language of its own
    rows += [(7, f"ein langer deutscher Text {i}", "de") for i in range(300)] + [(i, "el perro y el gato", "es") for i in range(100, 110)]
    docs = docs_of(rows, "doc_id long, text string, lang string")
    model = language.fit(docs, sample=30)
    assert model.languages == ["de", "en", "es", "fr"]
    seen = [language.counts(t)[0] for _, t, _ in rows]
    for b in {*seen[0].tolist(), *seen[-1].tolist()}:
        assert abs(model.idf[b] - (np.log((1 + len(rows)) / (1 + sum(b in at for at in seen))) + 1)) < 1e-9
    at, x = model.vector("the the dog")
    found, tf = language.counts("the the dog")
    raw = np.array([(1 + np.log(k)) * model.idf[b] for b, k in zip(found, tf)])
    assert (at == found).all() and np.allclose(x, raw / np.sqrt((raw**2).sum()))
    assert {r.lang_pred for r in language.predicted(docs.where("doc_id >= 100"), model, ["doc_id"]).collect()} == {"es"}
