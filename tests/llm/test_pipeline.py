from __future__ import annotations

import hashlib
from collections import Counter

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from cardloom.llm import mixing, quality, secretscan
from test_models import by_hand
from test_near import groups, jaccard_linked


def test_stages_keep_the_columns(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, sf).columns == docs.columns


def test_pipeline_against_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    machine = quality.fit(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    rows = sorted((r.doc_id, r.source, r.text) for r in docs.collect())
    rows = [r for r in rows if machine.score(r[2]) >= quality.GOOD]
    root, _ = groups(len(rows), jaccard_linked([r[2] for r in rows]))
    rows = [r for i, r in enumerate(rows) if root[i] == i]
    rows = [(i, s, secretscan.redacted(t, secretscan.spans(t)[1])) for i, s, t in rows]
    words = {i: mixing.re.findall(mixing.WORD, t or "") for i, _, t in rows}
    texts = {i: t for i, _, t in rows}
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = Counter()
    for i, size, _, _, taken in by_hand([(i, s, len(words[i])) for i, s, _ in rows]):
        while taken > 0:
            text = texts[i]
            if taken < size:
                ends = [m.end() for m in mixing.re.finditer(mixing.WORD, text)]
                text = text[: ends[taken - 1]]
            want[i, tuple(library.encode(text, add_special_tokens=False).ids)] += 1
            taken -= size
    got = Counter((r.doc_id, tuple(r.ids)) for r in corpus_pipeline.run(spark, sf).collect())
    assert got == want
    assert len(rows) > 50


def test_no_documents(spark, sf, tmp_path):
    spark.read.parquet(f"{sf}/documents.parquet").limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{sf}/labels.parquet").limit(0).write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_last_stage_decodes(spark, sf, docs_of):
    texts = {1: "Some words é 🎉\n  and more", 2: "", 3: None}
    name, stage = corpus_pipeline.STAGES[-1]
    got = {r.doc_id: (r.n_tokens, len(r.ids), r.decoded_sha256) for r in stage(spark, docs_of(list(texts.items())), sf).collect()}
    assert {i: d for i, (_, _, d) in got.items()} == {i: hashlib.sha256((t or "").encode()).hexdigest() for i, t in texts.items()}
    assert got[2][:2] == got[3][:2] == (0, 0) and got[1][0] == got[1][1] > 0


def test_odd_rows_pass_through(spark, sf):
    schema = "doc_id long, text string, lang string, source string, n_chars long, score double, size long, rid long"
    text = "Some words that are quite fine and stand here for a text of its own in the test. " * 3
    docs = spark.createDataFrame([(1, text, None, None, None, 1.0, 2, 3), (1, text + "more", "en", "a", 3, 1.0, 2, 3), (None, None, None, "a", 0, None, None, None), (5, "", "fr", "b", 0, 0.0, 0, 0)], schema)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns
        out.collect()
    assert corpus_pipeline.STAGES[-1][1](spark, docs, sf).count() == 4
