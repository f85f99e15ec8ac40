"""Labelled training rows from a lexicon and a corpus."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordsieve.functions import tokens as T
from wordsieve.functions.hashing import md5_number
from wordsieve.functions.text import clean_text, text_lines
from wordsieve.operators.joins import attach
from wordsieve.operators.segment import find_all

SENSITIVE, ORDINARY = 1.0, 0.0


def corpus_lines(df: DataFrame, ids: Sequence[str], text: Column, profile: str | None = None) -> DataFrame:
    """The lines of texts, cleaned when a profile is given; empty ones dropped: ids, line_no, line."""
    lines = df.select(*ids, F.posexplode(text_lines(text)).alias("line_no", "line"))
    return lines.withColumn("line", clean_text(F.col("line"), profile)).where(F.length("line") > 0)


def corpus_words(df: DataFrame, ids: Sequence[str], text: Column, profile: str | None = "train", min_length: int = 1) -> DataFrame:
    """All tokens longer than ``min_length`` characters, with repetitions: ids, pos, word."""
    kept = T.longer_than(T.words(clean_text(text, profile)), min_length)
    return df.select(*ids, F.posexplode(kept).alias("pos", "word"))


def vocabulary(words: DataFrame) -> DataFrame:
    return words.select("word").distinct()


def subtract(words: DataFrame, listed: DataFrame, row_key: Sequence[str]) -> DataFrame:
    """Words that are not listed, keeping repetitions. ``row_key`` tells repetitions apart."""
    return attach(words, listed.select("word").distinct(), ["word"], "left_anti", row_key)


def label_words(lexicon: DataFrame, corpus: DataFrame) -> DataFrame:
    """Lexicon words as 1.0 and the other words of the corpus as 0.0, each once: word, label.

    The union of the lexicon with the corpus less the lexicon, as one outer join of the two vocabularies.
    """
    positive = vocabulary(lexicon).withColumn("label", F.lit(SENSITIVE))
    return positive.join(vocabulary(corpus), "word", "full_outer").select(
        "word", F.coalesce("label", F.lit(ORDINARY)).alias("label")
    )


def as_terms(labelled: DataFrame) -> DataFrame:
    """Word rows in the layout the feature stages read: word as an array of one."""
    return labelled.withColumn("word", F.array("word"))


def segment_positives(lexicon: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Lexicon words as arrays of all dictionary words inside them, labelled 1.0; a word without any stands for itself."""
    parts = find_all(lexicon.select(F.col("word").alias("entry")), ["entry"], F.col("entry"), dictionary.select("word"))
    grouped = parts.groupBy("entry").agg(F.sort_array(F.collect_list("word")).alias("_parts"))
    joined = lexicon.select(F.col("word").alias("entry")).join(grouped, "entry", "left")
    return joined.select(F.coalesce("_parts", F.array("entry")).alias("word"), F.lit(SENSITIVE).alias("label"))


def hash_split(df: DataFrame, key: Column, train_percent: int = 80) -> DataFrame:
    """``df`` with ``part``: train or test by a hash of the key, the same in every run."""
    return df.withColumn("part", F.when(F.pmod(md5_number(key), F.lit(100)) < train_percent, "train").otherwise("test"))


def random_split(df: DataFrame, weights: Sequence[float] = (0.8, 0.2), seed: int = 11) -> list[DataFrame]:
    return df.randomSplit(list(weights), seed)


def parse_points(lines: DataFrame, line: Column) -> DataFrame:
    """``label,f1 f2 f3`` lines as label and an array of features."""
    parts = F.split(line, ",")
    return lines.withColumn("label", F.get(parts, F.lit(0)).cast("double")).withColumn(
        "features", F.split(F.get(parts, F.lit(1)), " ").cast("array<double>")
    )
