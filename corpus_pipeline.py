"""The pipeline over documents, in stages that are each written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordsieve.llm import decontaminate, mixing, near_dup, sharding, toxicity
from wordsieve.llm.common import quoted, read, ship
from wordsieve.session import stored


def packed(docs: DataFrame) -> DataFrame:
    """The columns that stages work on, beside each whole row as ``record``, whose names can't clash with theirs."""
    return docs.select("doc_id", "text", "source", F.struct(*[quoted(c) for c in docs.columns]).alias("record"))


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that score as toxic; the model learns from all labels."""
    labels = read(spark, sf_dir, "labels", "doc_id", "toxic").withColumnRenamed("toxic", "label")
    return toxicity.toxicity(packed(docs), labels).where("predicted = 0").select("record.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies: that of the smallest id. Shingles are of five words."""
    ship(spark)
    return near_dup.grouped(docs, shingle=5).where("first").select("record.*")


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that hold an item of the benchmark."""
    items = read(spark, sf_dir, "benchmark", "item_id", "text")
    return decontaminate.contaminated(packed(docs), items).where(F.size("matches") == 0).select("record.*")


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Emits each document as often as its source's weight asks for."""
    return mixing.emit(mixing.mix(packed(docs))).select("record.*")


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Deals all rows to shards in random order: the columns of documents, shard and slot."""
    ship(spark)
    return sharding.external_shuffle(docs)


STAGES = [
    ("toxicity", toxic),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontaminated),
    ("mixing", mixed),
    ("sharding", sharded),
]

# Classifiers and sketches have no SQL; tests hold the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
