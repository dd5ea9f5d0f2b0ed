"""Corpus pipeline over ``documents``: each stage reads what its predecessor kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from skyfold.llm import mixing, positional, quality, simhash, token_files
from skyfold.llm.common import table
from skyfold.session import materialize, new_path

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def filter_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component: the one with the smallest ``doc_id``."""
    return simhash.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    return positional.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample with the target shares of sources, languages and topics; documents of short cells come more than once."""
    return mixing.sampled_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the documents, read back: one row per document."""
    folder = new_path(spark, "token-ids")
    return token_files.read_ids(spark, folder, token_files.write_ids(docs, folder, TOKENIZER))


STAGES = [
    ("quality classifier", filter_quality),
    ("simhash near-dedup", deduplicate),
    ("benchmark decontamination", decontaminate),
    ("mixing to target weights", mix),
    ("token ids", encode),
]

#: The classifier and the tokenizer are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each written as Parquet and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = materialize(docs, name.replace(" ", "-"))
    return docs
