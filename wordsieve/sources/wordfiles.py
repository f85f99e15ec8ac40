"""Lexicon and corpus files: one word or one line of text per line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wordsieve.functions.hashing import word_id
from wordsieve.functions.text import BOM, trim_controls


def _category(by: str) -> Column:
    parts = F.split(F.input_file_name(), "/")
    if by == "file":
        return F.regexp_replace(F.url_decode(F.element_at(parts, -1)), "\\.[^.]*$", "")
    return F.regexp_replace(F.url_decode(F.element_at(parts, -2)), "^[^=]*=", "")


def load_word_files(spark: SparkSession, path: str, category_by: str = "file") -> DataFrame:
    """The words of a folder of word files, each once: word_id, word, category, source.

    Byte order marks, blanks and control characters around a word are dropped, empty lines skipped.
    The category is the name of the file, or of its folder with ``category_by="folder"``. A word in
    several files belongs to the first by name.
    """
    lines = spark.read.option("recursiveFileLookup", "true").text(path)
    word = trim_controls(F.regexp_replace(F.col("value"), f"^{BOM}", ""))
    named = lines.select(word.alias("word"), _category(category_by).alias("category")).where(F.col("word") != "")
    once = named.groupBy("word").agg(F.min("category").alias("category"))
    return once.select(word_id(F.col("word")).alias("word_id"), "word", "category", F.lit("file").alias("source"))


def read_lexicon(spark: SparkSession, path: str) -> DataFrame:
    """A lexicon table from parquet; a missing word reads as the literal ``word``."""
    return spark.read.parquet(path).withColumn("word", F.coalesce("word", F.lit("word")))


def read_corpus(spark: SparkSession, path: str) -> DataFrame:
    """Plain text files as one row per line: line."""
    return spark.read.text(path).select(F.col("value").alias("line"))
