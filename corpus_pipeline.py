"""The corpus pipeline: quality, near copies, contamination, mixture, shards.

Every stage takes what its predecessor kept, in the columns of ``documents``
and whole rows; the last adds the shard and the slot in it. All read whole
texts, few rows at a time, so the reader's arrays stay small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from curvewright.llm import decontaminate, mixing, quality, sharding, simhash_groups
from curvewright.llm.common import few_at_once, stored, table


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier (operator 5) does not reject."""
    return quality.good(few_at_once(docs), table(spark, sf_dir, "labels"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (operator 6): the smallest doc_id.

    Tiled comparison of wide fingerprints finds candidates; sets of five-word
    shingles link at a similarity of 0.8 or more.
    """
    return simhash_groups.one_of_each(few_at_once(docs))


def clean_of_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item (operator 7)."""
    return decontaminate.clean(few_at_once(docs), table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources mixed to their target weights (operator 8); a document may repeat."""
    return mixing.mixed(few_at_once(docs))


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows in 24 shards of near-equal bytes (operator 3): adds shard and slot."""
    return sharding.shard(few_at_once(docs))


STAGES = [
    ("quality", quality_filter),
    ("near_copies", near_copies),
    ("decontamination", clean_of_benchmark),
    ("mixture", mixture),
    ("shards", shards),
]

#: SQL cannot express the classifier; the pipeline is tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
