"""A corpus pipeline: language, exact and near duplicates, mixing, packing.

Every stage takes all that its predecessor kept and calls one operator of
``reelscope.llm``; its result is written as Parquet and read again as the
next stage's documents. All but the last return the columns of documents,
extra ones too. Rows without id, repeated rows, null, empty and very long texts
are documents like others, but for what each stage says; an empty table gives
an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from reelscope.llm.common import table
from reelscope.llm.exact_dedup import without_copies
from reelscope.llm.language_id import accepted
from reelscope.llm.mixing import mixed_documents
from reelscope.llm.packing import pack
from reelscope.llm.simhash import one_per_group
from reelscope.session import scratch_path


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in no language go: null and empty texts, those without a
    letter, and those whose best language has less than half of the posterior.
    A null lang is filled in. Equal texts are judged alike."""
    return accepted(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays: the longest original,
    then the smallest id, of rows repeated in full any one."""
    return without_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays: the smallest id, of a group
    without ids any one. Texts without a word are one group."""
    return one_per_group(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: twice, once or not at all,
    one per source cut to the words that are left. Texts without a word are
    never taken; a null source is one of its own; ties go by id."""
    return mixed_documents(docs, table(spark, sf_dir, "labels"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the training sequences: the tokens of each row, an end
    token after each, repeated rows as often as they are there."""
    return pack(docs)


STAGES = [("language_id", language), ("exact_dedup", exact), ("simhash_near_dedup", near),
          ("mix_sources", mixing), ("best_fit_packing", packing)]

#: The stages learn a model, hash with XXH64 and tokenise: SQL cannot say that.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline_{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
