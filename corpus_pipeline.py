"""Documents to token ids in five stages; each works on all that its predecessor kept."""

from __future__ import annotations

from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from footfall.llm import bpe, decontaminate, language, neardup, secretscan
from footfall.llm.shared import batch_whole_texts, table, written
from footfall.session import ship_package

#: Not expressible in SQL: trained models and token merges.
ORACLE_SQL = None
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the texts that have letters and whose language is likely."""
    return language.keep_known(docs)


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near duplicates, the one with the least id."""
    return neardup.keep_one(docs)


def remove_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that hold too little of the benchmark to count as contaminated."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps all documents, with secrets replaced by a marker."""
    return secretscan.redact(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens, token_ids and the decoded text of every document."""
    return bpe.encode_and_decode(docs, VOCABULARY, ["doc_id", "lang", "source"])


def _in_batches(stage):
    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        batch_whole_texts(spark)
        return stage(spark, docs, sf_dir)

    return run_stage


STAGES = [
    ("language ID", _in_batches(identify_language)),
    ("MinHash near-dedup", _in_batches(remove_near_duplicates)),
    ("benchmark decontamination", _in_batches(remove_contaminated)),
    ("secret scans", _in_batches(redact_secrets)),
    ("BPE encoding and decoding", _in_batches(encode)),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is a table in the shared folder."""
    ship_package(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
