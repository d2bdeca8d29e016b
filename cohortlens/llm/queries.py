"""The registered queries: each applies its operator, with production parameters, to a whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (bm25, bpe, centroids, decontamination, hard_negatives, langid, mixing, pii, pivots, quality, secrets, simhash,
               token_files)
from .common import table


def op1_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.summary(table(spark, sf_dir, "documents"))


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.summary(table(spark, sf_dir, "documents"))


def op3_pivots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivots.near_duplicates(table(spark, sf_dir, "embeddings"))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.summary(table(spark, sf_dir, "documents"))


def op6_bm25(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bm25.summary(table(spark, sf_dir, "documents"))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.summary(table(spark, sf_dir, "documents"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.summary(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.summary(table(spark, sf_dir, "documents"))


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.summary(table(spark, sf_dir, "documents"))


def op11_positional_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.summary(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_simplex_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.summary(table(spark, sf_dir, "embeddings"))


def op13_rtree_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.summary(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_langid": op1_langid,
    "op2_token_files": op2_token_files,
    "op3_pivots": op3_pivots,
    "op4_pii": op4_pii,
    "op5_quality": op5_quality,
    "op6_bm25": op6_bm25,
    "op7_secrets": op7_secrets,
    "op8_mixing": op8_mixing,
    "op9_simhash": op9_simhash,
    "op10_sentencepiece": op10_sentencepiece,
    "op11_positional_index": op11_positional_index,
    "op12_simplex_clusters": op12_simplex_clusters,
    "op13_rtree_negatives": op13_rtree_negatives,
}
ORACLE_SQL: dict[str, str] = {
    "op8_mixing": mixing.ORACLE,
    "op11_positional_index": decontamination.ORACLE,
    "op12_simplex_clusters": centroids.ORACLE,
    "op13_rtree_negatives": hard_negatives.ORACLE,
}
