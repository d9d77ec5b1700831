"""A training-corpus pipeline over ``documents``: drop toxic documents, keep one of
each group of near copies, drop documents with benchmark passages, mix the
sources into a training order, and deal the mixed corpus to shards.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last
return the columns of ``documents``.  Each stage's rows are written as Parquet and read
again as the next stage's documents, so a lost executor never costs more than a stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerlake.llm import decontam, mixing, sharding, similarity, toxicity
from ledgerlake.llm.common import read_table, written

SHARDS = 24


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that score 0.5 or more, by a model of the labelled ones among ``docs``."""
    return toxicity.drop_toxic(docs, read_table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a Jaccard index of 0.8 or more."""
    return similarity.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold ten consecutive words of a benchmark item (or a whole shorter item)."""
    return decontam.remove_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in training order, each once per pass that its source's target needs."""
    return mixing.training_order(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their shard, and their shard if there were one more."""
    return sharding.assign_shards(docs, [1.0] * SHARDS, added_weight=1.0)


STAGES = [("toxicity", drop_toxic), ("near_copies", drop_near_copies), ("decontamination", drop_contaminated),
          ("mixing", mix), ("sharding", shard)]

#: The stages score with a trained model and follow chains of links, which SQL does not express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
