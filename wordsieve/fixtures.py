"""A small harmless lexicon for examples, queries and tests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

INSULTS = ("trash", "idiot", "clown", "scum", "worthless", "moron", "pathetic", "loser", "stupid", "disgusting")


def insult_lexicon(spark: SparkSession) -> DataFrame:
    values = ", ".join(f"('{w}')" for w in INSULTS)
    return spark.sql(f"SELECT md5(col1) AS word_id, col1 AS word, 'insult' AS category FROM VALUES {values}")
