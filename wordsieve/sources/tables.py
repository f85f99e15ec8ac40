"""Reading the input tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wordsieve.sources.commits import size_of

# Bytes of a table's files for each of the tasks over which its rows are dealt, where these are more than cores.
PIECE = 32 * 1024 * 1024


def spread(df: DataFrame, size: int = 0) -> DataFrame:
    """Deal the rows of a table that is one file over the cores, or over more tasks if it takes ``size`` bytes and these are many.

    Rows are dealt round and by no key, so that what follows is planned as for a large table. Text work is bound by
    the processor; a table of many splits is read as it is by not asking for this.
    """
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, -(-size // PIECE)))


def read_table(spark: SparkSession, base: str, name: str, columns: list[str], dealt: bool = False, pieces: bool = False) -> DataFrame:
    """Read the named columns of a parquet table, dealt over the cores if asked and it is one file.

    ``pieces`` deals the rows of any table, so that no task has more than a piece of it, for work whose memory grows with a
    task's rows.
    """
    path = f"{base}/{name}.parquet"
    df = spark.read.parquet(path).select(*columns)
    return spread(df, size_of(spark, path)) if pieces or dealt and len(df.inputFiles()) == 1 else df


def stream_table(spark: SparkSession, base: str, name: str, per_batch: int | None = None) -> DataFrame:
    """The files of a parquet table as a stream, up to ``per_batch`` files at a time.

    The path is given as a pattern, which finds a table that is one file as well as one that is a folder.
    """
    schema = spark.read.parquet(f"{base}/{name}.parquet").schema
    reader = spark.readStream.schema(schema)
    if per_batch:
        reader = reader.option("maxFilesPerTrigger", per_batch)
    return reader.parquet(f"{base}/{name}.parque[t]")
