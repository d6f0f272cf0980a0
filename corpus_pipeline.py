"""From raw documents to token shards, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as
Parquet and read again as the next stage's documents. All but the last return the
columns of the documents they were given.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import decontaminate, mixing, near_dedup, token_shards, toxicity
from millrace.llm.common import settle, table
from millrace.llm.queries import byte_tokenizer


def _carried(docs: DataFrame) -> DataFrame:
    """Id and text, and the whole row under a name that no column can clash with."""
    return docs.select("doc_id", "text", F.struct(*docs.columns).alias("_row"))


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain does not find toxic."""
    labels = toxicity.label_columns(table(spark, sf_dir, "labels"))
    chain = toxicity.fit_chain(docs, labels, toxicity.CATEGORIES)
    scored = toxicity.with_scores(_carried(docs), chain)
    return scored.filter(~F.col("_flags")[len(toxicity.CATEGORIES) - 1]).select("_row.*")


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return near_dedup.one_of_each(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    found = decontaminate.with_matches(_carried(docs), table(spark, sf_dir, "benchmark"))
    return found.filter(F.size("matches") == 0).select("_row.*")


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources by weight; a document comes as often as it is taken."""
    return mixing.mixed_documents(docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token shards on disk, and what they hold of each document."""
    return token_shards.tokenise(docs, byte_tokenizer())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("tokens", token_stage),
]

#: Models, shingles and token files cannot be said in SQL; tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
