"""Joins of a large side with a word table of unknown size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A word table is broadcast only when it is measured to be below both bounds.
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 * 1024 * 1024

# Copies of the word table, and so tasks per hot key, in a shuffled join: at least and at most. In between they are an eighth of
# the shuffle's tasks, so that a key of a third of all rows gives a task less than three times the mean.
SALTS, MOST_SALTS = 16, 256

# Up to this many words are written into the plan as a set, so that texts are checked where they are read.
INLINE_WORDS = 5_000

# Larger dictionaries become automata, each of up to so many characters (some 15 bytes a character in every Python worker),
# and so many of them at a time. Where all places are sought the texts may be read so many times, for as many groups of automata.
# What is larger still is joined.
AUTOMATON_CHARS = 4_000_000
AUTOMATON_PARTS = 4
AUTOMATON_PASSES = 16

# A table of whole words, 16 bytes a word, is gathered by the driver up to so many of them. Of a larger dictionary only those
# words are gathered that the texts hold.
TABLE_WORDS = 2_000_000


def inline_words(table: DataFrame) -> list[str] | None:
    """The words of a small table, or None when it has more than ``INLINE_WORDS``."""
    rows = table.select("word").where(F.length("word") > 0).limit(INLINE_WORDS + 1).collect()
    return None if len(rows) > INLINE_WORDS else sorted({r.word for r in rows})


def footprint(table: DataFrame) -> tuple[Column, Column]:
    """Aggregates for the rows and the bytes of a table."""
    width = F.octet_length(F.concat_ws("", *[F.col(c).cast("string") for c in table.columns]))
    return F.count(F.lit(1)), F.coalesce(F.sum(width + 16 * len(table.columns)), F.lit(0))


def within_bounds(rows: int, size: int) -> bool:
    return rows <= BROADCAST_ROWS and size <= BROADCAST_BYTES


def fits_broadcast(table: DataFrame) -> bool:
    """Measure a table in one distributed aggregate and compare it with the bounds."""
    return within_bounds(*table.agg(*footprint(table)).first())


def attach(
    left: DataFrame,
    table: DataFrame,
    on: Sequence[str],
    how: str,
    salt_by: Sequence[str],
    broadcast: bool | None = None,
) -> DataFrame:
    """Join the large ``left`` with ``table``: broadcast when it fits, else shuffled with salt.

    Text follows Zipf's law, so a few words hold much of ``left``. In the shuffled form each key is
    spread over several tasks by a hash of ``salt_by`` (the row's own key), and ``table`` is copied once per salt.
    """
    if broadcast is None:
        broadcast = fits_broadcast(table)
    if broadcast:
        return left.join(F.broadcast(table), list(on), how)
    tasks = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salts = min(MOST_SALTS, max(SALTS, tasks // 8))
    salted = left.withColumn("_salt", F.pmod(F.xxhash64(*salt_by), F.lit(salts)).cast("int"))
    copies = table.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(copies, [*on, "_salt"], how).drop("_salt")
