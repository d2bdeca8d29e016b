"""The corpus pipeline: five stages, each one operator of ``cohortlens.llm``, over ``documents``.

Every stage is written as Parquet to the shared checkpoint folder and read again as the next one's
``docs``. Columns of ``docs`` beyond those of ``documents`` go along; defined results for NULLs,
empty and very long texts, ties and repeated rows are those of the operators.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.llm import bpe, mixing, pii, quality, simhash
from cohortlens.llm.common import materialize, table


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality classifier, learnt from ``labels`` outside the held-out fifth; rejected documents go."""
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    return quality.keep_good(docs, quality.train(docs, table(spark, sf_dir, "labels"), ~held_out))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-duplicates (three-word shingles, three bits); the smallest id of a group stays."""
    return simhash.keep_one(docs)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind in brackets; no document goes."""
    return pii.redact(docs)


def target_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of the target mix; one that the mix takes in several epochs comes as often."""
    return mixing.select(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The final documents with the ids of their texts (merge-dropout) in a further column ``ids``."""
    return bpe.encode(docs)


STAGES = [
    ("quality", good_documents),
    ("simhash", one_of_each_group),
    ("pii", without_personal_data),
    ("mixing", target_mix),
    ("sentencepiece", encoded),
]
#: A learnt model, checksums and merge agendas have no SQL form; tests/llm holds the brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
