"""Pipeline from raw documents to the token ids of a mix.

Each stage takes the documents its predecessor kept, as a table, and returns what
it keeps with the columns of documents; the last returns token ids and decodes
them. Where
``doc_id`` repeats, in the input or by the epochs of the mix, each row goes
through for itself.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardloom.llm import bpe, mixing, ngramjoin, quality, secretscan
from cardloom.llm.common import numbered, table, written

#: Learned scores and Bayesian pruning have no SQL form.
ORACLE_SQL = None


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, learned from all of their labels, does not reject."""
    machine = quality.fit(docs, table(spark, sf_dir, "labels"))
    names = [F.col(f"`{c}`") for c in docs.columns]
    scores = quality.scored(docs, machine, docs.columns, score_col="score of stage")
    return scores.where(F.col("`score of stage`") >= quality.GOOD).select(*names)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of each group of near duplicates."""
    rows = numbered(docs, "documents", "row of stage")
    found = ngramjoin.joined(rows.select(F.col("`row of stage`").alias("rid"), "doc_id", "text"))
    kept = found.where("kept").select(F.col("rid").alias("row of stage"))
    return rows.join(kept, "row of stage", "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their secrets marked and their lengths set anew."""
    return secretscan.redact(docs).withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars")))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of the sources; a document taken in two epochs comes twice, a document at the cut in part."""
    return mixing.mixed(docs, length_col="n_chars")


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document of the mix, and the digest of the text decoded from them: doc_id, ids, n_tokens, decoded_sha256."""
    return bpe.encode_and_decode(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality classifier", good_quality), ("n-gram Jaccard join", one_of_each_group), ("secret scans", without_secrets),
    ("mixing to target weights", mix), ("BPE encoding and decoding", token_ids),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
