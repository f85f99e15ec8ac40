"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# White space between words: blank and the six ASCII controls from tab to carriage return.
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"

# Characters that one block of text handed to numpy holds at most, but for a longer unbroken word.
BLOCK_CHARS = 1 << 19


def ship(spark: SparkSession) -> None:
    """Let Python workers find this package where the driver has it; a cluster gets it with --py-files."""
    top = str(Path(__file__).resolve().parents[2])
    paths = spark.sparkContext.environment.get("PYTHONPATH", "")
    if top not in paths.split(":"):
        spark.sparkContext.environment["PYTHONPATH"] = f"{top}:{paths}".rstrip(":")


def read(spark: SparkSession, base: str, table: str, *columns: str) -> DataFrame:
    """The named columns of a table of the given folder."""
    ship(spark)
    return spark.read.parquet(f"{base}/{table}.parquet").select(*columns)


def quoted(name: str) -> Column:
    """A column by its exact name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def without(df: DataFrame, *names: str) -> list[str]:
    """The columns of a frame but the named ones; Spark's names ignore case."""
    lower = {n.lower() for n in names}
    return [c for c in df.columns if c.lower() not in lower]


def remainder(key: Column, parts: int) -> Column:
    """crc32 of a key's text, modulo ``parts``; a null key counts as an empty text."""
    return F.pmod(F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), F.lit(parts))


def map_text(
    df: DataFrame,
    text: str,
    outputs: T.StructType,
    make: Callable[[], Callable[[list[str | None]], Sequence]],
    keep_text: bool = False,
) -> DataFrame:
    """Add columns that Python computes from a text, batch by batch.

    ``make`` runs once per task and returns a function from texts to a sequence of columns. Input columns
    that have the name of an output are replaced by it.
    """
    kept = without(df, *outputs.fieldNames(), *([] if keep_text else [text]))
    rows = df.select(*[quoted(c) for c in kept], quoted(text).alias("_text"))
    schema = T.StructType([*[df.schema[c] for c in kept], *outputs.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = make()
        for batch in batches:
            columns = compute(batch.column(batch.num_columns - 1).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *columns], names=schema.fieldNames())

    return rows.mapInArrow(run, schema)


def blocks(
    texts: Sequence[str | None], limit: int = BLOCK_CHARS, spaces: str | None = None, most_rows: int | None = None
) -> Iterator[tuple[list[int], list[str]]]:
    """Group texts into blocks of about ``limit`` characters and at most ``most_rows`` pieces: the rows, and a piece of text for each.

    Texts longer than ``limit`` are cut in front of white space that follows a word, so that no word is divided; where
    they are cut depends on the text alone. A word longer than a block stays whole. White space is that of Unicode, or
    the characters of ``spaces``.
    """
    is_space = str.isspace if spaces is None else spaces.__contains__
    rows: list[int] = []
    parts: list[str] = []
    held = 0
    for row, text in enumerate(texts):
        begin, size = 0, len(text or "")
        while begin < size:
            end = min(size, begin + limit)
            while end < size and not (is_space(text[end]) and not is_space(text[end - 1])):
                end += 1
            if held and held + end - begin > limit or len(rows) == most_rows:
                yield rows, parts
                rows, parts, held = [], [], 0
            rows.append(row)
            parts.append(text[begin:end])
            held += end - begin
            begin = end
    if rows:
        yield rows, parts
