"""A training corpus from documents: low quality and near-duplicates go, leaks go, sources are mixed, shards are dealt.

Every stage takes (spark, docs, sf_dir), works on all rows that its predecessor kept and returns a DataFrame; all but the last
return the columns of documents, more and clashing ones included. run() writes each stage's rows as Parquet in the shared folder and
reads them again. An empty table of documents gives empty ones throughout.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strandwork.llm import decontaminate, mixing, near_dedup, quality, sharding
from strandwork.llm.common import ship, table, written


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier scores below quality.REJECT_BELOW go.

    Null and empty texts score as average evidence does; rows of equal texts stay or go together. Without labels of both classes every
    score is the smoothed share of good labels.
    """
    return quality.kept_documents(docs, table(spark, sf_dir, "labels"))


def near_dedup_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates stays: that of the smallest doc_id, rows without one last; repeated rows once.

    Rows are compared by text, so several texts of one doc_id are several documents. Rows without words all stay.
    """
    ship(spark)
    return near_dedup.kept_documents(docs)


def leak_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go. Null, empty and short texts hold none but items of as few words; without items all stay."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are brought to their target weights: documents are left out or repeated, up to three times.

    A null source is a source. Rows without words are left out, as the mix takes no words of them; repeated rows share their fate.
    """
    return mixing.mixed_documents(docs)


def shard_slots(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row of the mix gets a shard and its place in it, whatever its doc_id; repeated rows count each."""
    ship(spark)
    return sharding.shard(docs, 24)


STAGES = [
    ("quality_filter", quality_filter),
    ("near_dedup_filter", near_dedup_filter),
    ("leak_filter", leak_filter),
    ("source_mix", source_mix),
    ("shard_slots", shard_slots),
]

#: Classifier, sampling and tiling can't be said in SQL: tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
