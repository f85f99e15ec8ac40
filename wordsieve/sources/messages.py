"""Message queues and files as streams or batches, and their sinks."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import StructType


def read_stream(
    spark: SparkSession,
    fmt: str,
    options: Mapping[str, str],
    path: str | None = None,
    schema: StructType | str | None = None,
) -> DataFrame:
    """A stream of any source. With ``kafka`` the key and value arrive as strings, empty values dropped."""
    reader = spark.readStream.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    rows = reader.load(path) if path else reader.load()
    return non_empty(decode(rows)) if fmt == "kafka" else rows


def kafka_options(servers: str, topics: list[str], per_batch: int | None = None) -> dict[str, str]:
    """Subscribe to several topics from their start; ``per_batch`` bounds the messages of a batch."""
    options = {"kafka.bootstrap.servers": servers, "subscribe": ",".join(topics), "startingOffsets": "earliest"}
    if per_batch:
        options["maxOffsetsPerTrigger"] = str(per_batch)
    return options


def decode(rows: DataFrame) -> DataFrame:
    return rows.select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"), "topic")


def non_empty(rows: DataFrame, value: str = "value") -> DataFrame:
    return rows.where(F.length(value) > 0)


def envelope(rows: DataFrame, body: Column, seed: int | None = None) -> DataFrame:
    """Decode a queue message and give it a random id and a random number from 1000 to 9999."""
    number = F.round(F.rand(seed) * 8999 + 1000).cast("int").cast("string")
    return rows.select("*", F.decode(body, "UTF-8").alias("payload"), F.uuid().alias("msg_id"), number.alias("num"))


# Fixed value: the key of all messages when a single constant key is asked for.
CONSTANT_KEY = "word"


def outgoing(rows: DataFrame, key: Column, value: Column, constant_key: bool = False) -> DataFrame:
    """Key and value of marked messages. One constant key would send all to one partition of the queue."""
    return rows.select((F.lit(CONSTANT_KEY) if constant_key else key.cast("string")).alias("key"), value.alias("value"))


def write_stream(
    rows: DataFrame,
    fmt: str,
    options: Mapping[str, str],
    checkpoint: str,
    path: str | None = None,
    every: str | None = None,
) -> DataStreamWriter:
    """A writer that appends to a sink; without ``every`` it takes what is there and stops."""
    writer = rows.writeStream.format(fmt).options(**options).option("checkpointLocation", checkpoint).outputMode("append")
    if path:
        writer = writer.option("path", path)
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)


def drain(writer: DataStreamWriter) -> None:
    """Run a stream until nothing is left, then stop it.

    For sources that bound their batches themselves: the trigger for what is available takes one batch of such a source only.
    """
    running = writer.trigger(processingTime="0 seconds").start()
    try:
        running.processAllAvailable()
    finally:
        running.stop()
