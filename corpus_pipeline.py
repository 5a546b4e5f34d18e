"""A training corpus from raw documents: reject, keep one of near duplicates, redact, mix, tokenise.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the next
stage's ``docs``. All but the last return the columns of ``documents``; each works on all rows that its predecessor kept:

* ``quality``: rows the classifier, fitted on these rows, rejects are dropped; rows without a word are rejected.
* ``near_duplicates``: of rows linked by a Jaccard similarity of 0.8 or more, directly or in a chain, the least doc_id
  stays; rows without shingles stay.
* ``secrets``: found spans are replaced in the text, n_chars follows; no row is dropped.
* ``mixing``: a row for every time the mix takes a document (0 to 3), the last turn possibly cut to its first words.
* ``tokens``: n_tokens, ids and the byte offset behind each token replace the text.

Empty tables pass through every stage. Nulls, repeated rows and further columns: see the operators.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from wakeline.llm import bpe, mixing, nearjoin, quality, secrets
from wakeline.llm.common import stored

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def accept_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.accept(docs)


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return nearjoin.keep_one(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encode(docs, RANKS)


STAGES = [
    ("quality", accept_quality),
    ("near_duplicates", keep_one_of_near_duplicates),
    ("secrets", redact_secrets),
    ("mixing", mix_sources),
    ("tokens", encode_tokens),
]

#: The classifier, the redaction and the tokeniser have no SQL form; tests hold the result against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
