"""The operators over the given tables, with the columns of their contracts."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from footfall.llm.bpe import encode_and_decode
from footfall.llm.decontaminate import contamination
from footfall.llm.neardup import near_duplicates
from footfall.llm import centroids, extraction, language, personal, quality, secretscan, sharding, spelling
from footfall.llm.neighbours import nearest
from footfall.llm.shared import batch_whole_texts, table
from footfall.llm.tokenfile import read_token_file, write_token_file
from footfall.session import scratch_path

#: The vocabulary file of the operators on token ids.
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secretscan.digest(secretscan.find_secrets(table(spark, sf_dir, "documents")))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("text_hash")


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_and_decode(table(spark, sf_dir, "documents"), VOCABULARY, ["doc_id"], digest=True)


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.place(table(spark, sf_dir, "documents"), sharding.shard_names(sharding.SHARDS))
    path = scratch_path(spark, "shards")
    sharding.write_shards(placed, path)
    return spark.read.schema(placed.schema).parquet(path).select("doc_id", "slot", "shard")


def op6_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"))


def op7_tokenfile(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "tokens")
    write_token_file(table(spark, sf_dir, "documents"), VOCABULARY, path, end_id=1)
    return read_token_file(spark, path)


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.predictions(table(spark, sf_dir, "documents"))


def op9_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op10_personal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal.digest(personal.find_personal(table(spark, sf_dir, "documents")))


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.clustered(table(spark, sf_dir, "embeddings"))[0]


def op12_maintext(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.main_text(table(spark, sf_dir, "pages"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def _in_batches(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        batch_whole_texts(spark)
        return query(spark, sf_dir)

    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {
        "op1_secrets": op1_secrets,
        "op2_decontaminate": op2_decontaminate,
        "op3_bpe": op3_bpe,
        "op4_quality": op4_quality,
        "op5_sharding": op5_sharding,
        "op6_neighbours": op6_neighbours,
        "op7_tokenfile": op7_tokenfile,
        "op8_language": op8_language,
        "op9_neardup": op9_neardup,
        "op10_personal": op10_personal,
        "op11_centroids": op11_centroids,
        "op12_maintext": op12_maintext,
        "op13_spelling": op13_spelling,
    }
    return {name: _in_batches(query) for name, query in found.items()}
