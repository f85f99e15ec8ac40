"""Delivery of batches to a queue, and reading from it, so that what is sent twice is taken once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordsieve.sources import commits
from wordsieve.streaming.flagging import BatchSink

MESSAGE = ["sent_batch", "sent_seq", "key", "value"]


def outbox(path: str, send: BatchSink) -> BatchSink:
    """A sink that hands the messages of a batch (key, value) to ``send``, numbered: sent_batch, sent_seq, key, value.

    The batch is written to the box first and its numbers are part of what is written, so a batch that is run again is
    sent with the same ones. Marks tell that a batch is complete in the box, and that it was sent: run again after the
    first, it is sent from the box; after the second, not at all. A crash in between leaves messages that were sent
    twice, which ``inbox`` tells by their numbers. Numbers of one key grow with its rows' places in the box; no key is gathered.
    """

    def sink(rows: DataFrame, batch_id: int) -> None:
        spark, box = rows.sparkSession, f"{path}/box/batch={batch_id}"
        if batch_id in commits.numbers(spark, f"{path}/sent"):
            return
        if batch_id not in commits.numbers(spark, f"{path}/begun"):
            numbered = rows.select(F.lit(batch_id).cast("bigint").alias("sent_batch"), F.monotonically_increasing_id().alias("sent_seq"), "key", "value")
            numbered.write.mode("overwrite").parquet(box)
            commits.put(spark, f"{path}/begun", batch_id, {"batch": batch_id})
        send(spark.read.parquet(box).select(*MESSAGE), batch_id)
        commits.put(spark, f"{path}/sent", batch_id, {"batch": batch_id})

    return sink


def enveloped(rows: DataFrame) -> DataFrame:
    """Messages for a queue that carries key and value only: the numbers go into the value, as JSON."""
    return rows.select("key", F.to_json(F.struct("sent_batch", "sent_seq", "value")).alias("value"))


def opened(rows: DataFrame) -> DataFrame:
    """Messages as they were before ``enveloped``."""
    said = F.from_json("value", "sent_batch bigint, sent_seq bigint, value string").alias("said")
    return rows.select("key", said).select("said.sent_batch", "said.sent_seq", "key", "said.value")


def inbox(path: str, take: BatchSink) -> BatchSink:
    """A sink for the reader's side: of the messages (sent_batch, sent_seq, …) each is handed to ``take`` once.

    What was taken is noted below ``path`` by the sender's batch. A batch of the reader looks only at the notes of the
    sender's batches that it holds, so the work doesn't grow with the history; its own notes are left out and written
    anew when it is run again.
    """

    def sink(rows: DataFrame, batch_id: int) -> None:
        spark = rows.sparkSession
        once = rows.dropDuplicates(["sent_batch", "sent_seq"])
        batches = [r.sent_batch for r in once.select("sent_batch").distinct().collect()]
        new = once.join(taken(spark, path, batches, batch_id), ["sent_batch", "sent_seq"], "left_anti").persist()
        try:
            notes = new.select("sent_seq", "sent_batch", F.lit(batch_id).alias("taken"))
            notes.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("sent_batch", "taken").parquet(f"{path}/taken")
            take(new, batch_id)
        finally:
            new.unpersist()

    return sink


def taken(spark: SparkSession, path: str, batches: list[int], batch_id: int) -> DataFrame:
    """The numbers of the messages that other batches of the reader took of the given batches of the sender."""
    fs, where = commits._files(spark, f"{path}/taken")
    if not fs.exists(where):
        return spark.createDataFrame([], "sent_batch bigint, sent_seq bigint")
    notes = spark.read.schema("sent_seq bigint, sent_batch bigint, taken bigint").parquet(f"{path}/taken")
    return notes.where(F.col("sent_batch").isin(batches) & (F.col("taken") != batch_id)).select("sent_batch", "sent_seq")
