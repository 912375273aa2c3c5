"""Quality classifier: a factorisation machine.

Method: a document is a sparse vector of hashed words, statistics of its
structure and its size. The score adds to the linear part all pairwise
interactions, each the product of two low-rank vectors, in linear time: half the
square of the sum minus the sum of squares, per factor. It is trained by adaptive
gradient steps on the logistic loss, on at most ``SAMPLE`` labelled rows, those
with the smallest hash of their id. Every row is scored.

Cases: a null text is read as empty; an empty one has statistics of zero and a
score like any. Texts are read whole. Labels that are null, and labelled ids
without a document, teach nothing; where an id has several labels the smallest
counts, where it has several texts the largest. Without any label the score is
0.5. Repeated rows are scored each for itself. Extra columns are left out. An
empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardloom.llm.common import Shared, map_rows, python_ready

#: Most labelled rows that are learned from.
SAMPLE = 20_000
#: Hash buckets of words, factors, passes, step, weight of the penalty.
BUCKETS, FACTORS, PASSES, STEP, PENALTY = 1 << 15, 4, 4, 0.1, 1e-5
#: Score from which a row is predicted good.
GOOD = 0.3
STATS = 20
DIM = BUCKETS + STATS
_SIGNS = np.zeros(128, dtype=bool)
_SIGNS[[ord(c) for c in "#$%&*+/<=>@\\^_`{|}~"]] = True


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Positions and values of a text's features."""
    text = text or ""
    words = text.split()
    stats = np.zeros(STATS)
    if not words:
        return np.arange(BUCKETS, DIM, dtype=np.int32), stats.astype(np.float32)
    hashes = pd.util.hash_array(np.array(text.lower().split(), dtype=object), categorize=False)
    buckets, counts = np.unique((hashes >> np.uint64(20)) % np.uint64(BUCKETS), return_counts=True)
    tf = 1 + np.log(counts)
    tf /= np.sqrt(tf @ tf)

    a = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    n = len(a)
    low = a[a < 128]
    upper, lower = ((low >= 65) & (low <= 90)).sum(), ((low >= 97) & (low <= 122)).sum()
    signs = _SIGNS[low].sum()
    grams = hashes
    for _ in range(4):
        grams = grams[:-1] * np.uint64(0x9E3779B97F4A7C15) + hashes[len(hashes) - len(grams) + 1 :] if len(grams) > 1 else grams
    lines = [line for line in text.split("\n") if line.strip()]
    lengths = np.array([len(w) for w in words])
    stats[:] = (
        upper / max(1, upper + lower), ((low >= 48) & (low <= 57)).sum() / n, signs / n, (low == 33).sum() / n * 5, (low == 124).sum() / n * 5,
        (n - len(low)) / n, (low == 10).sum() / n * 10, ((low == 46) | (low == 44)).sum() / n * 10, min(1.0, lengths.mean() / 10), (lengths <= 3).mean(),
        min(1.0, lengths.max() / 50), np.log1p(len(words)) / 10, np.log1p(n) / 12, len(buckets) / len(words), counts.max() / len(words),
        len(np.unique(grams)) / len(grams), len(set(lines)) / max(1, len(lines)), min(1.0, len(words) / max(1, len(lines)) / 200),
        (low < 32).sum() / n * 5, min(1.0, len(words) / 50),
    )
    return np.concatenate((buckets.astype(np.int32), np.arange(BUCKETS, DIM, dtype=np.int32))), np.concatenate((tf, stats)).astype(np.float32)


class Machine:
    """Weights: ``bias``, ``linear`` [DIM], ``factors`` [DIM, FACTORS]."""

    def __init__(self, bias: float, linear: np.ndarray, factors: np.ndarray):
        self.bias, self.linear, self.factors = bias, linear, factors

    def raw(self, at: np.ndarray, x: np.ndarray) -> float:
        v = self.factors[at] * x[:, None]
        s = v.sum(axis=0)
        return float(self.bias + self.linear[at] @ x + 0.5 * (s @ s - (v * v).sum()))

    def score(self, text: str | None) -> float:
        return _sigmoid(self.raw(*features(text)))

    def to_bytes(self) -> bytes:
        return np.concatenate(([self.bias], self.linear, self.factors.ravel())).astype(np.float64).tobytes()

    @staticmethod
    def from_bytes(data: bytes) -> Machine:
        flat = np.frombuffer(data)
        return Machine(float(flat[0]), flat[1 : DIM + 1], flat[DIM + 1 :].reshape(DIM, FACTORS))


def _sigmoid(x: float) -> float:
    return float(1 / (1 + np.exp(-x))) if x >= 0 else float(np.exp(x) / (1 + np.exp(x)))


def train(rows: list[tuple[np.ndarray, np.ndarray, int]]) -> Machine:
    """Machine of (positions, values, label) rows, in the order given; the same rows give the same machine."""
    rng = np.random.default_rng(7)
    share = min(max(np.mean([y for _, _, y in rows]), 0.01), 0.99)
    m = Machine(float(np.log(share / (1 - share))), np.zeros(DIM), rng.normal(0, 0.05, (DIM, FACTORS)))
    g_bias, g_linear, g_factors = 1.0, np.ones(DIM), np.ones((DIM, FACTORS))
    for _ in range(PASSES):
        for i in rng.permutation(len(rows)):
            at, x, y = rows[i]
            f = m.factors[at]
            v = f * x[:, None]
            s = v.sum(axis=0)
            w = m.linear[at]
            error = _sigmoid(m.bias + w @ x + 0.5 * (s @ s - (v * v).sum())) - y
            d_linear = error * x + PENALTY * w
            d_factors = error * (x[:, None] * s - v * x[:, None]) + PENALTY * f
            g_bias += error * error
            g_linear[at] += d_linear**2
            g_factors[at] += d_factors**2
            m.bias -= STEP * error / np.sqrt(g_bias)
            m.linear[at] = w - STEP * 10 * d_linear / np.sqrt(g_linear[at])
            m.factors[at] = f - STEP * d_factors / np.sqrt(g_factors[at])
    return m


def fit(docs: DataFrame, labels: DataFrame, where: Column | None = None, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = SAMPLE) -> Machine | None:
    """Machine learned from at most ``sample`` labelled rows that meet ``where`` (on ``doc_id``); None without labels."""
    known = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("label")).where("doc_id is not null and label is not null")
    if where is not None:
        known = known.where(where)
    known = known.groupBy("doc_id").agg(F.min("label").alias("label"))
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    # at most ``sample`` rows of two numbers
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).join(F.broadcast(known), "doc_id").groupBy("doc_id", "label").agg(F.max("text").alias("text"))

    def row(key, label, text):
        at, x = features(text)
        return key, label, at.tobytes(), x.tobytes()

    vectors = map_rows(texts, lambda: row, f"doc_id {dict(texts.dtypes)['doc_id']}, label int, at binary, x binary")

    def learn(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("doc_id")
        parsed = [(np.frombuffer(a, dtype=np.int32), np.frombuffer(x, dtype=np.float32).astype(np.float64), int(y > 0)) for a, x, y in zip(rows["at"], rows["x"], rows["label"], strict=True)]
        return pd.DataFrame({"machine": [train(parsed).to_bytes()]})

    python_ready(docs.sparkSession)
    # one task learns from the bounded sample
    found = vectors.groupBy(F.lit("all").alias("all")).applyInPandas(learn, "machine binary").collect()
    return Machine.from_bytes(found[0].machine) if found else None


def scored(docs: DataFrame, machine: Machine | None, columns: list[str], text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``columns`` of ``docs`` and the score, a double, of each row."""
    shared = Shared(docs.sparkSession, None if machine is None else machine.to_bytes())
    source = docs.select(*[F.col(f"`{c}`") for c in columns], F.col(text_col).alias("_text of score"))
    kinds = dict(source.dtypes)

    def factory():
        m = None if shared.value is None else shared.built("machine", Machine.from_bytes)
        return lambda *values: (*values[:-1], 0.5 if m is None else m.score(values[-1]))

    return map_rows(source, factory, ", ".join(f"`{c}` {kinds[c]}" for c in columns) + f", `{score_col}` double")


def held_out(column: str = "doc_id", folds: int = 5, fold: int = 0) -> Column:
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % folds == fold, F.lit(False))
