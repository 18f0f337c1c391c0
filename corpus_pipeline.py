"""From documents to packed training sequences: quality rules, exact dedup, near-duplicate groups,
pseudonyms, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows the one before has kept.  All but the last
return the columns of ``documents``; what a stage returns is written as Parquet and read again."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from lyceum.llm.exact_dedup import columns_of, drop_exact_copies
from lyceum.llm.near_dedup import drop_near_copies
from lyceum.llm.packing import pack
from lyceum.llm.pseudonyms import pseudonymise
from lyceum.llm.quality_rules import drop_failing
from lyceum.llm.queries import PSEUDONYM_KEY
from lyceum.session import prepare, scratch_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a rule rejects go."""
    prepare(spark)
    return drop_failing(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest id stays."""
    prepare(spark)
    return drop_exact_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: five words, 0.8."""
    prepare(spark)
    return drop_near_copies(spark, docs)


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced; ``n_chars`` is counted anew where there is one."""
    replaced = pseudonymise(docs, PSEUDONYM_KEY)
    if "n_chars" in docs.columns:
        replaced = replaced.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars")))
    return replaced.select(*columns_of(docs))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens."""
    prepare(spark)
    return pack(spark, docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality_rules", quality), ("exact_dedup", exact), ("near_dedup", near), ("pseudonyms", private),
          ("best_fit_packing", packing)]

ORACLE_SQL = None  # the token ids of the last stage are beyond SQL; tests/llm compares with plain code


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
