"""The training-data pipeline: five stages over ``documents``.

Every stage takes what its predecessor kept and returns the columns of
``documents`` (the last one the shard assignment).  ``run`` writes each stage
as Parquet in the shared checkpoint folder and reads it back, so a lost
executor repeats tasks of one stage only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from playlens.llm import decontaminate, mixing, near_dedup, sharding, toxicity
from playlens.llm.common import read_table, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity network does not reject."""
    return toxicity.clean_documents(docs, read_table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, five words and similarity 0.8."""
    return near_dedup.one_of_each_group(docs, num=80, den=100)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.clean_documents(docs, read_table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the source weights take them."""
    return mixing.mixed_documents(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every row that is left."""
    return sharding.shard_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", shard),
]

#: SQL cannot express the toxicity stage; the pipeline is tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
