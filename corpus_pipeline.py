"""From raw documents to training shards: five stages, each one operator over all that the stage before has kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from silverline.llm import decontamination, mixing, quality, sharding, simhash
from silverline.llm.common import materialise, table

#: Bytes of a training shard.
SHARD_BYTES = 64 << 20


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules; the model is fitted on the labels.

    Null and empty texts have no words and go. Rows that repeat an id or a text are judged alike, each by itself. Columns of any name are kept as
    they are; no documents give none.
    """
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.judge(docs, model).where("kept").select("whole.*")


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates, the document with the smallest id.

    Texts without words are near duplicates of each other. A missing id ranks last; of rows that repeat the smallest id one stays.
    """
    return simhash.drop_near_duplicates(docs, shingle=3, distance=3)


def keep_uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the benchmark does not contaminate.

    Null and empty texts have no words and stay; items without words match nothing, and an empty benchmark contaminates nothing. Rows that repeat an id
    are judged each by its text.
    """
    found = decontamination.find_contamination(docs, table(spark, sf_dir, "benchmark"))
    return found.where("not contaminated").select("whole.*")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the mix takes: a document once for each pass over its source that takes some of it.

    A missing source is a source of its own. Texts without words are never taken. Rows that repeat an id are documents of their own.
    """
    return mixing.mixed_documents(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each document of the mix goes.

    Every row gets a place, copies and missing ids too; equal texts share a shard. No documents need no shard.
    """
    return sharding.kd_tree_shards(docs, target_bytes=SHARD_BYTES)


STAGES = [
    ("quality rules", keep_good),
    ("simhash near-dedup", keep_one_of_each),
    ("benchmark decontamination", keep_uncontaminated),
    ("mixing to target weights", mix),
    ("sharding", shard),
]

#: The quality model, the fingerprints' hash and the mix's permutations are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each one's rows written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
