"""Document frequencies and vocabulary that follow a stream, as counts per batch that add up."""

from __future__ import annotations

import math

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wordsieve.functions.hashing import md5_bucket
from wordsieve.operators import features
from wordsieve.sources import commits

# One table for both: documents that hold a bucket, and occurrences of a word; the bucket -1 counts documents.
COUNTS = "bucket bigint, word string, n bigint"
DOCUMENTS = -1


def count_batch(rows: DataFrame, terms: Column, path: str, batch_id: int, buckets: int) -> None:
    """Write the counts of a batch of documents to a folder of its own.

    A batch that is run again replaces its counts, so nothing is counted twice, and batches add up in any order.
    """
    words = rows.select(F.monotonically_increasing_id().alias("_row"), F.filter(terms, lambda t: t.isNotNull()).alias("_terms"))
    held = words.select(F.explode(F.array_distinct(F.transform("_terms", lambda t: md5_bucket(t, buckets)))).alias("bucket"))
    per_bucket = held.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).select("bucket", F.lit(None).cast("string").alias("word"), "n")
    per_word = words.select(F.explode("_terms").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n")).select(F.lit(None).cast("bigint").alias("bucket"), "word", "n")
    total = words.agg(F.count(F.lit(1)).alias("n")).select(F.lit(DOCUMENTS).cast("bigint").alias("bucket"), F.lit(None).cast("string").alias("word"), "n")
    per_bucket.unionByName(per_word).unionByName(total).write.mode("overwrite").parquet(f"{path}/counts/batch={batch_id}")


def _counts(spark: SparkSession, path: str) -> DataFrame:
    """The counts of all batches: those that a base has summed, and of later batches."""
    base = commits.latest(spark, f"{path}/commits")
    rows = spark.read.schema(f"{COUNTS}, batch bigint").parquet(f"{path}/counts")
    if base is None:
        return rows.drop("batch")
    summed = spark.read.schema(COUNTS).parquet(base[1]["base"])
    return rows.where(F.col("batch") > base[1]["upto"]).drop("batch").unionByName(summed)


def compact(spark: SparkSession, path: str, upto: int) -> None:
    """Sum the counts of the batches up to a number that will not be run again, so that readers don't meet all of them."""
    known = commits.latest(spark, f"{path}/commits")
    before = known[1]["upto"] if known else -1
    rows = spark.read.schema(f"{COUNTS}, batch bigint").parquet(f"{path}/counts").where((F.col("batch") > before) & (F.col("batch") <= upto)).drop("batch")
    if known:
        rows = rows.unionByName(spark.read.schema(COUNTS).parquet(known[1]["base"]))
    base = f"{path}/base/upto={upto}"
    rows.groupBy("bucket", "word").agg(F.sum("n").alias("n")).write.mode("overwrite").parquet(base)
    commits.put(spark, f"{path}/commits", (known[0] if known else 0) + 1, {"base": base, "upto": upto})


def vocabulary(spark: SparkSession, path: str) -> DataFrame:
    """All words so far and how often they came: word, n."""
    return _counts(spark, path).where(F.col("word").isNotNull()).groupBy("word").agg(F.sum("n").alias("n"))


def weights(spark: SparkSession, path: str, buckets: int) -> list[float]:
    """The weight of each bucket, as a fit to all documents so far gives it: ln((m + 1) / (df + 1))."""
    rows = _counts(spark, path).where(F.col("bucket").isNotNull()).groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    n = {r.bucket: r.n for r in rows}
    documents = n.get(DOCUMENTS, 0)
    return [math.log((documents + 1) / (n.get(k, 0) + 1)) for k in range(buckets)]


def refreshed(spark: SparkSession, model: PipelineModel, path: str, buckets: int) -> PipelineModel:
    """A classifier with its weights taken from all documents so far, without a look at any of them."""
    return features.with_idf(model, weights(spark, path, buckets))
