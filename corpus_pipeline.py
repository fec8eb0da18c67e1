"""From raw documents to token ids: toxic documents go, then copies, near copies and contaminated ones.

Defined results: each row is a document of its own, also where ids are null or repeated, and of a group
of copies exactly one row stays: the longest of exact ones, else the one with the smallest id, null ids
last; empty and null texts are copies of each other in exact dedup and go through all other stages;
texts of any length pass whole; an empty table gives an empty result; further columns, whatever their
names, stay until the last stage. Names that begin with ``_hit_`` or equal ``_toxic_score`` are taken.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tagweave.llm import bpe, decontaminate, exact_dedup, minhash, toxicity
from tagweave.llm.common import stage
from tagweave.llm.queries import TOKENIZER

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Trains on the labels of the folder, and keeps documents below the threshold of toxicity."""
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of equal texts."""
    return exact_dedup.drop_copies(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near duplicates."""
    return minhash.drop_near_copies(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that are not contaminated by the benchmark of the folder."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def as_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, the ids and what they decode to, of each document that is left."""
    return bpe.encode(docs, public_tokenizers.path(TOKENIZER))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", without_toxic),
    ("exact dedup", without_copies),
    ("near dedup", without_near_copies),
    ("decontamination", without_benchmark),
    ("bpe", as_tokens),
]

#: A trained classifier and a tokenizer cannot be said in SQL; tests compare with plain loops.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies all stages to the documents of a folder; what a stage keeps is written before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
