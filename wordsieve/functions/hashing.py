"""Hash values that any SQL engine can repeat."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def md5_number(key: Column) -> Column:
    """The first 32 bits of the md5 as a number."""
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint")


def md5_bucket(key: Column, buckets: int) -> Column:
    return F.pmod(md5_number(key), F.lit(buckets).cast("bigint"))


def word_id(word: Column) -> Column:
    return F.md5(word)
