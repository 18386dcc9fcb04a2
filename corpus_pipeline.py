"""Training-corpus pipeline over ``documents``: five stages, each one operator.

Every stage takes (spark, docs, sf_dir) and returns the columns of documents;
the last returns the packed pieces.  Nulls, empty and repeated rows follow the
operators' rules: texts without words or letters are rejected by the first
stage, other stages keep them as they say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vacancylab.llm import crf_langid, pattern_packing, secrets_battery, signature_join, systematic_mix
from vacancylab.llm._tables import materialize, read_table
from vacancylab.session import ensure_checkpoint_dir, ship_package

#: Below this mean posterior no language fits: with a few languages, about a coin toss among them.
MIN_LANGUAGE_SCORE = 0.3


def _prepare(spark: SparkSession) -> None:
    ship_package(spark)
    ensure_checkpoint_dir(spark)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a recognisable language."""
    _prepare(spark)
    found = crf_langid.with_language(docs, language="__language", score="__score")
    return found.where((F.col("__language") != crf_langid.UNKNOWN)
                       & (F.col("__score") >= MIN_LANGUAGE_SCORE)).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    _prepare(spark)
    return signature_join.drop_near_duplicates(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts are masked."""
    _prepare(spark)
    return secrets_battery.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated or left out until the sources stand at their target weights."""
    _prepare(spark)
    return systematic_mix.mix_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents, placed in sequences."""
    _prepare(spark)
    return pattern_packing.pack_documents(docs)


STAGES = [("language_id", language_id), ("near_dedup", near_dedup), ("secret_scan", secret_scan),
          ("mix_sources", mix_sources), ("pack", pack)]

#: SQL expresses neither the model nor the tokenizer; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's result kept in the shared folder."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
