"""The corpus pipeline: stages over ``documents``, each written as Parquet and read again by the next."""

from __future__ import annotations

import os
import warnings

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygrid.llm import lines, outliers, packing, pii, simhash
from tallygrid.llm.storage import Scratch

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
#: The secret of the pseudonyms. Without CORPUS_KEY a fixed one is used, which is known to anyone and said aloud.
KEY = os.environ.get("CORPUS_KEY", "key of the registered query")


def _measured(docs: DataFrame, columns: list[str]) -> DataFrame:
    """The columns of documents, ``n_chars`` following the text as it is now."""
    return docs.withColumn("n_chars", F.length("text").cast("bigint")).select(*columns)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules, or lie far from their language and source, go."""
    return outliers.filtered(docs, Scratch(spark, "outliers"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines like an earlier one go; their documents stay, empty if need be."""
    return _measured(lines.deduplicated(docs, Scratch(spark, "lines")), docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return simhash.survivors(docs, Scratch(spark, "simhash"))


def pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data becomes pseudonyms; all documents stay."""
    if "CORPUS_KEY" not in os.environ:
        warnings.warn("CORPUS_KEY is not set: pseudonyms are made with a key that anyone can look up", stacklevel=2)
    return _measured(pii.pseudonymised(docs, KEY), docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences: the pieces of all documents with their ids and places."""
    return packing.pack(docs, TOKENIZER, scratch=Scratch(spark, "packing"))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("pseudonyms", pseudonyms),
    ("packed", packed),
]

#: SQL can't express these stages; tests/llm holds their operators, not the chain, against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scratch = Scratch(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        docs = scratch.keep(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
