"""Registered queries of the llm operators: thin wrappers over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import oracle
from .common import read_table
from .conversations import repair_damaged
from .language_id import language_ids
from .nn_descent import nearest
from .packing import pack
from .quality_model import quality_scores
from .quality_rules import quality_rules
from .sentence_pieces import piece_digests
from .sharding import shard_by_bytes
from .simhash import simhash_components
from .substring import substring_digests
from .token_files import token_round_trip
from .toxicity import toxicity_scores
from .vector_codes import vector_codes


def bpe_path() -> str:
    """The public byte-level BPE file; its place is a parameter of the operators."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read_table(spark, sf_dir, "documents"), bpe_path(), size=1024, end_id=0)


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(read_table(spark, sf_dir, "documents"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(read_table(spark, sf_dir, "documents"), n_words=4, radius=4)


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"), threshold=0.3)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"), threshold=0.5)


def op6_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(read_table(spark, sf_dir, "embeddings"), n_neighbours=10, every=100)


def op7_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return piece_digests(read_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_round_trip(read_table(spark, sf_dir, "documents"), bpe_path(), end_id=2)


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_by_bytes(read_table(spark, sf_dir, "documents"), 8)


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_digests(read_table(spark, sf_dir, "documents"), window=13)


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes(read_table(spark, sf_dir, "embeddings"))


def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_ids(read_table(spark, sf_dir, "documents"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_damaged(read_table(spark, sf_dir, "conversations"))


OPERATORS = [
    op1_packing, op2_quality_rules, op3_simhash, op4_quality_classifier, op5_toxicity, op6_nn_descent, op7_sentence_pieces,
    op8_token_files, op9_sharding, op10_substring_dedup, op11_vector_codes, op12_language_id, op13_conversation_repair,
]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in OPERATORS}


def oracle_sql() -> dict[str, str]:
    return dict(oracle.SQL)
