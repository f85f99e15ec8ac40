"""Keeping the lexicon: additions, deletions, review, versions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordsieve.functions.hashing import word_id
from wordsieve.functions.text import normalise_word

# The outcome of adding a word.
EXISTS, CREATED, FAILED = 0, 1, 2


def as_lexicon(words: DataFrame, category: str, source: str) -> DataFrame:
    """Distinct words as lexicon rows: word_id, word, category, source."""
    return (
        words.select("word").where(F.length("word") > 0).distinct()
        .select(word_id(F.col("word")).alias("word_id"), "word", F.lit(category).alias("category"), F.lit(source).alias("source"))
    )


def matchable(lexicon: DataFrame, profile: str | None = "train") -> DataFrame:
    """The lexicon in the form texts take after cleaning: entry as written, word cleaned and in lower case.

    Entries of which nothing is left are dropped; of several with one form the first by name is kept.
    """
    forms = lexicon.select(F.col("word").alias("entry"), normalise_word(F.col("word"), profile).alias("word"))
    return forms.where(F.length("word") > 0).groupBy("word").agg(F.min("entry").alias("entry"))


def new_words(incoming: DataFrame, lexicon: DataFrame, arrival: Sequence[str]) -> DataFrame:
    """Words not yet listed, with the first arrival of each: word, arrival columns."""
    first = incoming.where(F.length("word") > 0).groupBy("word").agg(F.min(F.struct(*arrival)).alias("_first"))
    return first.join(lexicon.select("word"), "word", "left_anti").select("word", "_first.*")


def upsert_status(incoming: DataFrame, lexicon: DataFrame, arrival: Sequence[str]) -> DataFrame:
    """Outcome of adding each incoming word: 1 for the first copy of a new one, 0 when it exists, 2 when empty.

    ``arrival`` orders and identifies the incoming rows. The first copies are found by an aggregate
    and joined back by arrival, so that a frequent word meets no single task.
    """
    created = new_words(incoming, lexicon, arrival).select(*arrival, F.lit(True).alias("_created"))
    status = (
        F.when(F.coalesce(F.length("word"), F.lit(0)) == 0, FAILED).when(F.col("_created"), CREATED).otherwise(EXISTS)
    )
    return incoming.join(created, list(arrival), "left").withColumn("status", status).drop("_created")


def insert(lexicon: DataFrame, incoming: DataFrame, category: str, source: str) -> DataFrame:
    """The lexicon with the new ones among the incoming words."""
    added = as_lexicon(incoming, category, source).join(lexicon.select("word"), "word", "left_anti")
    return lexicon.unionByName(added, allowMissingColumns=True)


def delete_words(lexicon: DataFrame, words: DataFrame) -> DataFrame:
    return lexicon.join(words.select("word").distinct(), "word", "left_anti")


def delete_status(lexicon: DataFrame, words: DataFrame) -> DataFrame:
    """For each distinct word to delete, whether it was listed: word, found."""
    listed = lexicon.select("word", F.lit(True).alias("_listed"))
    asked = words.select("word").where(F.col("word").isNotNull()).distinct()
    return asked.join(listed, "word", "left").select("word", F.coalesce("_listed", F.lit(False)).alias("found"))


def delete_ids(lexicon: DataFrame, ids: DataFrame) -> DataFrame:
    return lexicon.join(ids.select("word_id").distinct(), "word_id", "left_anti")


def clear(lexicon: DataFrame) -> DataFrame:
    """The empty lexicon of the same columns."""
    return lexicon.where(F.lit(False))


def list_words(lexicon: DataFrame) -> DataFrame:
    return lexicon.select("word").distinct()


def size(lexicon: DataFrame) -> DataFrame:
    return lexicon.agg(F.count(F.lit(1)).alias("size"))


def review(lexicon: DataFrame, candidates: DataFrame, decisions: DataFrame) -> DataFrame:
    """Apply human decisions (word, action): ``confirm`` takes a candidate in, ``add`` any word, ``delete`` one out."""
    confirmed = candidates.select("word").join(decisions.where("action = 'confirm'").select("word").distinct(), "word", "left_semi")
    wanted = confirmed.unionByName(decisions.where("action = 'add'").select("word"))
    return delete_words(insert(lexicon, wanted, "reviewed", "review"), decisions.where("action = 'delete'"))


CHANGES = "word string, category string, op string, version bigint, writer string"


def append_version(changes: DataFrame, path: str, version: int, writer: str = "main") -> None:
    """Write a set of changes (word, category, op) as one version of a writer; writing it again replaces it.

    ``op`` is ``add`` or ``delete``. Each writer has folders of its own, so none replaces what another wrote under
    the same number, and older versions are never touched.
    """
    changes.select("word", "category", "op").write.mode("overwrite").parquet(f"{path}/version={version}/writer={writer}")


def read_versions(spark: SparkSession, path: str, with_writer: bool = False) -> DataFrame:
    """All changes: word, category, op, version, and the writer if asked."""
    changes = spark.read.schema(CHANGES).option("basePath", path).parquet(path)
    return changes if with_writer else changes.drop("writer")


def stream_versions(spark: SparkSession, path: str, per_batch: int | None = None) -> DataFrame:
    """Changes as they are appended: word, category, op, version."""
    reader = spark.readStream.schema(CHANGES)
    if per_batch:
        reader = reader.option("maxFilesPerTrigger", per_batch)
    return reader.parquet(path).drop("writer")


def current(changes: DataFrame, version: int | None = None) -> DataFrame:
    """The lexicon as of a version (the latest by default): word_id, word, category, version."""
    known = changes if version is None else changes.where(F.col("version") <= version)
    last = known.groupBy("word").agg(F.max(F.struct("version", "op", "category")).alias("_last")).select("word", "_last.*")
    return last.where("op = 'add'").select(word_id(F.col("word")).alias("word_id"), "word", "category", "version")


def delta(changes: DataFrame, since: int) -> DataFrame:
    """Words added after a version; on a versioned table only the newer folders are read."""
    return changes.where((F.col("version") > since) & (F.col("op") == "add")).select("word", "version")
