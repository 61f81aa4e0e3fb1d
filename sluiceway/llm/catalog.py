"""The registered queries of the corpus operators and their SQL equivalents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sluiceway.llm import sql
from sluiceway.llm.common import documents
from sluiceway.llm.exact_dedup import exact_dedup
from sluiceway.llm.jaccard_join import jaccard_components
from sluiceway.llm.language_id import identify_languages
from sluiceway.llm.line_dedup import drop_boilerplate
from sluiceway.llm.lm_scoring import score_texts
from sluiceway.llm.media import media_columns
from sluiceway.llm.mixing import mix
from sluiceway.llm.packing import pack
from sluiceway.llm.sharding import shard
from sluiceway.llm.token_files import token_files


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(documents(spark, sf_dir), 24)


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_boilerplate(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files(documents(spark, sf_dir))


def op4_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media_columns(documents(spark, sf_dir))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(documents(spark, sf_dir)).drop("row_hash")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(documents(spark, sf_dir)).drop("row_hash")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_languages(documents(spark, sf_dir))


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(documents(spark, sf_dir))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(documents(spark, sf_dir), k=4, num=85, den=100).drop("row_hash", "kept")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_sharding, op2_line_dedup, op3_token_files, op4_media, op5_packing, op6_exact_dedup, op7_mixing, op8_language_id, op9_lm_scoring, op10_jaccard_join)}


def oracle_sql() -> dict[str, str]:
    return {"op2_line_dedup": sql.LINE_DEDUP, "op6_exact_dedup": sql.EXACT_DEDUP, "op7_mixing": sql.MIXING, "op10_jaccard_join": sql.JACCARD}
