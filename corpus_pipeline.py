"""Corpus preparation: five stages from raw documents to packed sequences.

Each stage takes (spark, docs, sf_dir), calls one operator of ``hrforge.llm``, and
returns a DataFrame that is written as Parquet and read back as the next stage's docs.
All stages but the last keep the columns of ``documents``.

1. toxicity: the model trained on ``labels`` drops the documents it calls toxic;
2. exact dedup: one row of each group of equal texts stays;
3. near dedup: one document of each component of linked documents stays;
4. secrets: reported spans are masked in the text (documents stay, n_chars follows);
5. packing: pieces of the remaining documents, placed in sequences of 4096 tokens.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from hrforge.llm import exact_dedup, ngram_join, packing, secrets, toxicity
from hrforge.llm.common import documents, labels, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, labels(spark, sf_dir))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.drop_near_copies(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.mask_secrets(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("toxicity", drop_toxic), ("exact_dedup", drop_copies), ("ngram_join", drop_near_copies),
          ("secret_scan", mask_secrets), ("packing", pack)]

#: SQL can express neither the trained model nor the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written in the shared folder."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = table(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
