"""A corpus pipeline over ``documents``: toxic documents go, near copies go, contaminated documents go, personal data is
pseudonymised, and the texts are encoded.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the next
one's documents. All but the last return the columns of the documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from lapstack.llm import decontamination, pii, sentencepieces, simhash, toxicity
from lapstack.llm.common import table
from lapstack.llm.queries import PIECES, PII_KEY
from lapstack.session import stage


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    scored = toxicity.with_scores(docs, table(spark, sf_dir, "labels"))
    return scored.filter("predicted = 0").select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_per_class(docs, shingle=4, max_bits=4)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.pseudonymise(docs, PII_KEY).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sentencepieces.with_pieces(docs, public_tokenizers.path(PIECES)).select(
        "doc_id", "lang", "source", "n_tokens", "token_ids"
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("pii", hide_personal_data),
    ("sentencepiece", encode),
]

# trained weights, fingerprints and merges are not expressible in SQL; tests hold the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
