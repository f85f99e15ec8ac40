"""A two-pass external shuffle into shards of equal row counts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wordsieve.llm.common import quoted, without
from wordsieve.session import stored

SHARDS = 24
SEED = 29
# Bytes and rows of records that a bucket is meant to hold; a bucket is shuffled in the memory of one task.
BUCKET_BYTES = 32 << 20
BUCKET_ROWS = 1 << 18
# Rows that a bucket hands on at once.
BATCH_ROWS = 1 << 12


def record_bytes(df: DataFrame) -> Column:
    """Bytes of a row: those of its texts and eight for each other column."""
    sizes = [
        F.coalesce(F.octet_length(quoted(f.name)), F.lit(0)) if isinstance(f.dataType, T.StringType) else F.lit(8)
        for f in df.schema.fields
    ]
    return sum(sizes, F.lit(0)).cast("long")


def external_shuffle(
    df: DataFrame,
    shards: int = SHARDS,
    seed: int = SEED,
    bucket_bytes: int = BUCKET_BYTES,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """The rows of ``df`` with ``shard`` (int) and ``slot`` (long), in random order over ``shards`` shards.

    First pass: each row gets a number as it is written once, and a seeded hash of that number scatters the rows
    over buckets that fit a task's memory. The hash takes no part of the row's content, so copies of one row, however many,
    are spread like any others, and a lost executor finds the same rows again. Second pass: each bucket is put in order and
    shuffled by Fisher-Yates. A row's place, the rows of the buckets before plus its place in its own, is dealt round the
    shards: counts differ by one at most and slots have no gap. Only the counts of buckets, bounded by the
    bytes of the input over ``bucket_bytes``, are collected.

    Null values and equal rows are rows like any others; columns named shard or slot are replaced; an empty table
    gives an empty result.
    """
    kept = without(df, "shard", "slot")
    source = df.select(*[quoted(c) for c in kept])
    rows = stored(
        source.select(F.struct(*[quoted(c) for c in kept]).alias("record"), record_bytes(source).alias("bytes"))
        .withColumn("row", F.monotonically_increasing_id()),
        "shuffle-rows",
    )
    total = rows.agg(F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"), F.count(F.lit(1)).alias("n")).first()
    buckets = int(max(1, -(-total.bytes // bucket_bytes), -(-total.n // bucket_rows)))
    bucket = F.pmod(F.xxhash64(F.lit(seed), F.col("row")), F.lit(buckets)).cast("int")
    counts = {r.bucket: r.n for r in rows.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n")).collect()}
    before = np.concatenate([[0], np.cumsum([counts.get(b, 0) for b in range(buckets)])]).astype("int64")
    offsets = df.sparkSession.sparkContext.broadcast(before)
    schema = T.StructType([rows.schema["record"], T.StructField("shard", T.IntegerType()), T.StructField("slot", T.LongType())])

    def shuffled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if not held:
            return
        part = pa.Table.from_batches(held).combine_chunks()
        of, row = part["bucket"].to_numpy(), part["row"].to_numpy()
        order = np.lexsort([row, of])
        for b in np.unique(of):
            own = order[of[order] == b]
            # numpy's permutation is a Fisher-Yates shuffle.
            own = own[np.random.Generator(np.random.PCG64([seed, int(b)])).permutation(len(own))]
            place = offsets.value[b] + np.arange(len(own))
            for k in range(0, len(own), BATCH_ROWS):
                at = place[k : k + BATCH_ROWS]
                record = part["record"].take(pa.array(own[k : k + BATCH_ROWS])).combine_chunks()
                columns = [record, pa.array((at % shards).astype("int32")), pa.array(at // shards)]
                yield from pa.Table.from_arrays(columns, names=schema.fieldNames()).to_batches()

    # One bucket to a partition, in order: places rise from partition to partition.
    placed = rows.select("row", "record", bucket.alias("bucket")).repartitionById(buckets, F.col("bucket")).mapInArrow(shuffled, schema)
    return placed.select("record.*", "shard", "slot")


def write_shards(shuffled: DataFrame, path: str, shards: int = SHARDS) -> None:
    """One folder per shard, its rows in the order of their slots: a file from each bucket, by name in their order.

    ``shuffled`` is what external_shuffle gave for so many ``shards``. Each bucket is written where it was shuffled, so no row moves again.
    """
    shuffled.sortWithinPartitions("shard", "slot").write.partitionBy("shard").option("compression", "zstd").parquet(path)
