"""The corpus pipeline: quality, near duplicates, benchmark passages, mixture and shards.

Each stage takes (spark, docs, sf_dir) and works on all rows of docs; all but the last return the columns of docs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabweave.llm import decontamination, fm, jaccard, mixing, sharding
from tabweave.llm.common import fresh, stored, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorisation machine, fitted on the labels of docs, does not reject."""
    score, good = fresh(docs.columns, "__score", "__good")
    scored = fm.classified(docs, fm.trained(docs, table(spark, sf_dir, "labels")), whole=True, names=(score, good))
    return scored.where(F.col(good) == 1).select(*(F.col(f"`{c}`") for c in docs.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of texts similar in 80 of 100 of their five-word shingles."""
    return jaccard.deduplicated(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """docs with shard and slot."""
    return sharding.shuffle_to_shards(docs, [F.col("doc_id"), F.xxhash64("text")])


STAGES = [("quality classifier", quality), ("n-gram Jaccard join", near_duplicates), ("benchmark decontamination", decontaminated), ("mixing sources to target weights", mixed), ("sharding", shards)]
#: The shuffles by hash and the trained classifier have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
