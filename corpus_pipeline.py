"""From raw documents to packed training sequences: five stages, each an operator of tidemark.llm.

A stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and
read back as the docs of the next one. All but the last return the columns of their docs,
extra ones and such that are called like the operators' own included. A null text counts as
an empty one, and so does a null text's copy; an empty table goes through all stages.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import exact, jaccard, packing, substring, toxicity
from tidemark.llm.common import importable, written

#: Neither the models nor the similarity search can be said in SQL; tests compare with brute force.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model learnt from the labels doesn't call toxic. Rows with a null id are scored like others."""
    importable(spark)
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.drop_toxic(docs, model)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, the one with the largest id; a null id is less than any other."""
    importable(spark)
    return exact.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents, in the order of ids, without near copies of one that stays before them; rows without an id stay.

    SimHash groups bring the closest copies together; texts too far apart for it meet by their rarest shingles.
    """
    importable(spark)
    return jaccard.drop_near_copies(docs)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the sentences of runs that occur before in the corpus; rows without id or text as they are."""
    importable(spark)
    return substring.drop_repeats(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents in windows of at most 1024 tokens; an empty text has a piece, its closing id."""
    importable(spark)
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("substring_dedup", drop_repeats),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
