"""From raw documents to packed training sequences, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and gives a DataFrame; :func:`run` writes it as Parquet
and hands the next stage what it reads back. All stages but the last return the columns of their
documents, and each works on every row its predecessor kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.llm import language, mixing, packing, pii, simhash
from panelcast.llm.queries import word_tokenizer
from panelcast.session import written

#: SQL has no trained network, SimHash components or tokenizer; tests compare with plain versions.
ORACLE_SQL = None


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that are null, have no letter, or fit no learned language go.

    The model learns from all labelled rows that are not held out, and what fits is calibrated on all of
    them. Without any, all texts with a letter stay.
    """
    return language.keep_learned(docs, language.train_on_all(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays, the one with the smallest id."""
    return simhash.first_of_each(docs, shingle=4, bits=4)


def remove_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and the terms that reveal it are generalised; every document stays."""
    return pii.sanitised(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Four fifths of the tokens, by the target weights of domains, languages and sources."""
    # the whole row in one column, so that the columns the tree is made of clash with none of it
    leaves = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"), "doc_id", "text", "lang", "source", mixing.domain().alias("domain")
    )
    chosen = mixing.mixed(leaves, mixing.LEVELS, mixing.WEIGHTS, share=0.8)
    return chosen.select(*(F.col(f"doc.`{c}`").alias(c) for c in docs.columns))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens. Workers have served other stages, so they remember fewer words."""
    return packing.packed(docs, word_tokenizer(), words_kept=150_000)


STAGES = [
    ("language identification", identify_language),
    ("near duplicates", drop_near_duplicates),
    ("personal data", remove_personal_data),
    ("source mixing", mix_sources),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
