"""Language identification.

Method: sparse multinomial logistic regression on TF-IDF of hashed character
n-grams, trained by follow-the-regularised-leader with elastic-net penalties, and
calibrated with one temperature on rows kept out of that training. Document
frequencies are counted over all rows that may be learned from; the weights are
learned from at most ``SAMPLE`` of them, taken in turn from the languages by the
smallest hash of the id. Every row is predicted. What the one task that learns gets
is a sparse vector per row, at most 12 bytes a bucket however long the text is; its
state is two numbers per bucket and language of the sample, and the model that is
broadcast holds the weights that are not zero.

Cases: a null text, or one without a letter, is ``und`` with score 0. Texts are
read whole. Rows without a language teach nothing; where an id has several texts
in a language the largest teaches, and it counts as one when the sample is chosen. With nothing to learn from all rows are
``und``. Repeated rows are predicted each for itself. Extra columns are left out.
An empty table gives an empty table.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardloom.llm.common import CHUNK, Shared, arrow_schema, map_batches, map_rows, python_ready, written

#: Most rows the weights are learned from.
SAMPLE = 12_000
BUCKETS, GRAMS = 1 << 15, (1, 2, 3)
#: Follow-the-regularised-leader: step, smoothing, elastic net, passes; one row in this many is kept for the temperature.
ALPHA, BETA, L1, L2, PASSES, KEEP = 0.5, 1.0, 0.05, 0.1, 2, 8
#: Slices of the hash by which rows are counted before they are ranked.
SLICE_BITS = 16
UNKNOWN = "und"
_LETTER = re.compile(r"[^\W\d_]")


def counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a text's character n-grams and how often each occurs. What is no letter parts words."""
    a = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    letter = (a >= 97) & (a <= 122) | (a >= 0xAA) & ((a < 0x2000) | (a > 0x206F)) & (a != 0xD7) & (a != 0xF7)
    a = np.where(letter, a, np.uint64(32))
    keep = np.ones(len(a), dtype=bool)
    keep[1:] = letter[1:] | letter[:-1]
    a = np.concatenate((np.array([32], dtype=np.uint64), a[keep], np.array([32], dtype=np.uint64)))
    total = np.zeros(BUCKETS, dtype=np.int64)
    for n in GRAMS:
        if len(a) < n:
            break
        h = np.full(len(a) - n + 1, n, dtype=np.uint64)
        for k in range(n):
            h = (h + a[k : k + len(h)]) * np.uint64(0x9E3779B97F4A7C15)
        total += np.bincount((h >> np.uint64(49)).astype(np.int64), minlength=BUCKETS)
    at = np.flatnonzero(total)
    return at, total[at]


class Model:
    def __init__(self, languages: list[str], idf: np.ndarray, weights: np.ndarray, temperature: float = 1.0):
        self.languages, self.idf, self.weights, self.temperature = languages, idf, weights, temperature

    def vector(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        at, tf = counts(text)
        x = (1 + np.log(tf)) * self.idf[at]
        return at, x / max(np.sqrt(x @ x), 1e-12)

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.languages or not _LETTER.search(text):
            return UNKNOWN, 0.0
        at, x = self.vector(text)
        p = softmax(self.weights[:, at] @ x / self.temperature)
        best = int(p.argmax())
        return self.languages[best], float(p[best])

    def to_bytes(self) -> bytes:
        at = np.flatnonzero(self.weights)
        head = json.dumps({"languages": self.languages, "temperature": self.temperature, "weights": len(at)}).encode()
        parts = (self.idf.astype(np.float64), at.astype(np.int64), self.weights.ravel()[at].astype(np.float64))
        return len(head).to_bytes(8, "big") + head + b"".join(p.tobytes() for p in parts)

    @staticmethod
    def from_bytes(data: bytes) -> Model:
        end = 8 + int.from_bytes(data[:8], "big")
        head = json.loads(data[8:end])
        middle = end + 8 * BUCKETS
        weights = np.zeros(len(head["languages"]) * BUCKETS)
        weights[np.frombuffer(data, np.int64, head["weights"], middle)] = np.frombuffer(data, np.float64, head["weights"], middle + 8 * head["weights"])
        return Model(head["languages"], np.frombuffer(data, np.float64, BUCKETS, end), weights.reshape(-1, BUCKETS), head["temperature"])


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max())
    return e / e.sum()


def train(rows: list[tuple[np.ndarray, np.ndarray, str]], idf: np.ndarray) -> Model:
    """Model of (buckets, values, language) rows; the same rows in the same order give the same model."""
    languages = sorted({language for *_, language in rows})
    number = {language: i for i, language in enumerate(languages)}
    model = Model(languages, idf, np.zeros((len(languages), BUCKETS)))
    vectors = [(at, x, number[language]) for at, x, language in rows]
    kept = [i for i in range(len(rows)) if i % KEEP == KEEP - 1]
    learned = [i for i in range(len(rows)) if i % KEEP != KEEP - 1]
    z, n = np.zeros((len(languages), BUCKETS)), np.zeros((len(languages), BUCKETS))

    def weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
        return np.where(np.abs(z) <= L1, 0.0, (np.sign(z) * L1 - z) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    rng = np.random.default_rng(11)
    for _ in range(PASSES):
        for i in rng.permutation(learned):
            at, x, y = vectors[i]
            z_at, n_at = z[:, at], n[:, at]
            w = weights(z_at, n_at)
            error = softmax(w @ x)
            error[y] -= 1
            g = error[:, None] * x
            n_new = n_at + g * g
            z[:, at] = z_at + g - (np.sqrt(n_new) - np.sqrt(n_at)) / ALPHA * w
            n[:, at] = n_new
    model.weights = weights(z, n)
    model.temperature = _temperature([(model.weights[:, vectors[i][0]] @ vectors[i][1], vectors[i][2]) for i in kept])
    return model


def _temperature(logits: list[tuple[np.ndarray, int]]) -> float:
    """Temperature of the least log loss, by golden sections between 1/20 and 20 on a logarithmic scale.

    As if one row in n + 2 had another language, so that few or perfectly parted rows do not give certainty.
    """
    if not logits or len(logits[0][0]) < 2:
        return 1.0
    other = 1 / (len(logits) + 2)

    def loss(t: float) -> float:
        total = 0.0
        for z, y in logits:
            logs = np.log(np.maximum(softmax(z / np.exp(t)), 1e-300))
            total -= (1 - other) * logs[y] + other * (logs.sum() - logs[y]) / (len(z) - 1)
        return float(total)

    low, high, part = np.log(0.05), np.log(20.0), (5**0.5 - 1) / 2
    for _ in range(30):
        a, b = high - part * (high - low), low + part * (high - low)
        if loss(a) <= loss(b):
            high = b
        else:
            low = a
    return float(np.exp((low + high) / 2))


def _document_frequencies(texts: DataFrame) -> np.ndarray:
    """Smoothed inverse document frequency of each bucket, counted over all rows of ``text``."""
    out = arrow_schema("bucket int, n long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(BUCKETS + 1, dtype=np.int64)
        for batch in batches:
            for start in range(0, batch.num_rows, CHUNK):
                for text in batch.column(0).slice(start, CHUNK).to_pylist():
                    df[counts(text)[0]] += 1
                    df[BUCKETS] += 1
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(df[at])], schema=out)

    df = np.zeros(BUCKETS + 1, dtype=np.int64)
    for r in map_batches(texts.select("text"), run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        df[r.bucket] = r.n
    return np.log((1 + df[BUCKETS]) / (1 + df[:BUCKETS])) + 1


def fit(docs: DataFrame, where: Column | None = None, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE) -> Model:
    """Model learned from the rows that meet ``where`` (on ``doc_id``) and have a text and a language."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    rows = rows.where("doc_id is not null and lang is not null and text is not null and text <> ''")
    if where is not None:
        rows = rows.where(where)
    idf = _document_frequencies(rows)
    # counts per slice of the hash tell from which slice on a language has enough, so few rows beyond ``sample`` are ranked
    hashed = rows.select("doc_id", "lang").distinct().withColumn("hash", F.xxhash64("doc_id")).withColumn("slice", F.shiftrightunsigned("hash", 64 - SLICE_BITS))
    counts = hashed.groupBy("lang", "slice").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("lang").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    last = written(counts.withColumn("before", before).where(F.col("before") < sample).groupBy("lang").agg(F.max("slice").alias("last")), "language-slices")
    turn = Window.partitionBy("lang").orderBy("slice", "hash", "doc_id")
    chosen = hashed.join(last, "lang").where("slice <= last").withColumn("turn", F.row_number().over(turn)).where(F.col("turn") <= sample)
    chosen = chosen.orderBy("turn", "lang", "doc_id").limit(sample).select("doc_id", "lang")
    # at most ``sample`` rows of an id and a language
    texts = rows.join(F.broadcast(chosen), ["doc_id", "lang"]).groupBy("doc_id", "lang").agg(F.max("text").alias("text"))

    spark = docs.sparkSession
    shared = Shared(spark, idf)

    def row(key, language, text):
        at, x = Model([], shared.value, np.zeros((0, BUCKETS))).vector(text)
        return key, language, at.astype(np.int32).tobytes(), x.tobytes()

    vectors = map_rows(texts, lambda: row, f"doc_id {dict(texts.dtypes)['doc_id']}, lang string, at binary, x binary")

    def learn(found: pd.DataFrame) -> pd.DataFrame:
        found = found.sort_values(["doc_id", "lang"])
        parsed = [(np.frombuffer(a, np.int32), np.frombuffer(x), language) for a, x, language in zip(found["at"], found["x"], found["lang"], strict=True)]
        return pd.DataFrame({"model": [train(parsed, shared.value).to_bytes()]})

    python_ready(spark)
    # one task learns from the bounded sample
    got = vectors.groupBy(F.lit("all").alias("all")).applyInPandas(learn, "model binary").collect()
    return Model.from_bytes(got[0].model) if got else Model([], idf, np.zeros((0, BUCKETS)))


def predicted(docs: DataFrame, model: Model, columns: list[str], text_col: str = "text") -> DataFrame:
    """``columns`` of ``docs``, ``lang_pred string`` and ``score double`` of each row."""
    shared = Shared(docs.sparkSession, model.to_bytes())
    source = docs.select(*columns, F.col(text_col).alias("_text"))
    kinds = dict(source.dtypes)

    def factory():
        m = shared.built("language", Model.from_bytes)
        return lambda *values: (*values[:-1], *m.predict(values[-1]))

    return map_rows(source, factory, ", ".join(f"`{c}` {kinds[c]}" for c in columns) + ", lang_pred string, score double")
