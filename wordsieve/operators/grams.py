"""A stored index of a versioned lexicon by the character grams of its entries, for entries that contain a phrase."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wordsieve.functions.hashing import word_id
from wordsieve.operators import snapshots
from wordsieve.operators.joins import attach
from wordsieve.session import stored
from wordsieve.sources import commits

# Grams have up to three characters: shorter queries are looked up by grams of their own length, longer ones by their rarest of three.
SIZE = 3
# Folders that the postings of a version are dealt over by gram. A search reads those of its grams.
BUCKETS = 64

POSTINGS = "gram string, word string, op string, version bigint, bucket int"
COUNTS = "gram string, n bigint"


def grams(word: Column, sizes: tuple[int, ...] = tuple(range(1, SIZE + 1))) -> Column:
    """The distinct grams of a word."""

    def of(n: int) -> Column:
        last = F.length(word) - n + 1
        return F.when(last > 0, F.transform(F.sequence(F.lit(1), last), lambda i: F.substring(word, i, F.lit(n)))).otherwise(F.array().cast("array<string>"))

    return F.array_distinct(F.flatten(F.array(*[of(n) for n in sizes])))


def bucket(gram: Column) -> Column:
    return F.pmod(F.xxhash64(gram), F.lit(BUCKETS)).cast("int")


def follow(spark: SparkSession, lexicon: str, path: str) -> int:
    """Take the changes of a versioned lexicon since the last time into the index; the version it stands for is returned.

    Only the words that changed are read and only their grams written, beside what is there. The new postings are
    complete before a commit names them. Of two that follow at once one commits.
    """
    known = commits.latest(spark, f"{path}/commits")
    said = known[1] if known else {"upto": 0, "cleared": 0, "folders": []}
    upto = snapshots.head(spark, lexicon).number
    if upto == said["upto"]:
        return upto
    changed = snapshots.changes(spark, lexicon, said["upto"], upto)
    cleared = changed.where("op = 'clear'").agg(F.max("version")).first()[0] or said["cleared"]
    folder = f"{path}/data/{uuid.uuid4().hex}"
    rows = changed.where((F.col("version") > cleared) & (F.length("word") > 0)).groupBy("word").agg(F.max(F.struct("version", "op")).alias("_l"))
    posted = rows.select(F.explode(grams(F.col("word"))).alias("gram"), "word", "_l.op", "_l.version").withColumn("bucket", bucket(F.col("gram")))
    posted.repartition("bucket").write.partitionBy("bucket").parquet(f"{folder}/postings")
    counted = spark.read.schema(POSTINGS).parquet(f"{folder}/postings").groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    counted.write.parquet(f"{folder}/counts")
    folders = [f for f in said["folders"] if cleared == said["cleared"]] + [folder]
    number = (known[0] if known else 0) + 1
    if not commits.put(spark, f"{path}/commits", number, {"upto": upto, "cleared": cleared, "folders": folders}):
        return follow(spark, lexicon, path)
    return upto


def search(spark: SparkSession, path: str, queries: DataFrame) -> DataFrame:
    """For each phrase (query) the entries that contain it: query, word, word_id; equal to ``match.phrase_search_many``.

    Each phrase is looked up by one gram, the rarest that it holds, and the entries listed under that are compared with
    it. A deleted entry has a later posting under each of its grams that says so. Empty and null phrases find nothing.
    """
    known = commits.latest(spark, f"{path}/commits")
    asked = queries.select("query").where(F.length("query") > 0).distinct()
    if known is None or not known[1]["folders"]:
        return asked.select("query", F.lit("").alias("word"), F.lit("").alias("word_id")).where(F.lit(False))
    folders = known[1]["folders"]
    union = lambda kind, schema: reduce(DataFrame.unionByName, [spark.read.schema(schema).parquet(f"{f}/{kind}") for f in folders])
    size = F.least(F.length("query"), F.lit(SIZE))
    own = F.when(size == 1, grams(F.col("query"), (1,))).when(size == 2, grams(F.col("query"), (2,))).otherwise(grams(F.col("query"), (3,)))
    listed = asked.select("query", F.explode(own).alias("gram"))
    counts = union("counts", COUNTS).groupBy("gram").agg(F.sum("n").alias("n"))
    # A gram that no entry has rules the phrase out, and counts as the rarest.
    rated = listed.join(counts, "gram", "left")
    rarest = stored(rated.groupBy("query").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram")).alias("_r")).where("_r.n > 0").select("query", "_r.gram"), "rarest")
    needed = [r.b for r in rarest.select(bucket(F.col("gram")).alias("b")).distinct().collect()]
    postings = union("postings", POSTINGS).where(F.col("bucket").isin(needed)).select("gram", "word", "op", "version")
    met = attach(postings, rarest, ["gram"], "inner", ["word"]).where(F.contains("word", F.col("query")))
    last = met.groupBy("query", "word").agg(F.max(F.struct("version", "op"))["op"].alias("op"))
    return last.where("op = 'add'").select("query", "word", word_id(F.col("word")).alias("word_id"))
