"""Finding new candidate words in arriving messages, and keeping their text."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from wordsieve.functions import messages as J
from wordsieve.functions import tokens as T
from wordsieve.functions.text import clean_text
from wordsieve.operators import classify, lexicon
from wordsieve.sources import commits
from wordsieve.sources.tables import spread
from wordsieve.streaming.flagging import present

Keep = Callable[[DataFrame, int], None]

CANDIDATES = "word string, batch_id bigint"

# The batch intervals of the two discovery jobs.
EVERY_NAIVE_BAYES = "60 seconds"
EVERY_PERCEPTRON = "20 seconds"


def batch_words(texts: DataFrame, text: Column, ngrams: bool = False, min_length: int = 1) -> DataFrame:
    """The distinct terms of a batch, or of their joins with neighbours: word."""
    terms = T.context_ngrams(T.words(text)) if ngrams else T.longer_than(T.words(text), min_length)
    return texts.select(F.explode(terms).alias("word")).distinct()


def predicted_sensitive(words: DataFrame, model: PipelineModel, refit_idf: bool = False) -> DataFrame:
    """Words that the model takes for sensitive: word."""
    rows = words.select(F.col("word").alias("_word"), F.array("word").alias("word"))
    scored = classify.predict(model, rows, refit_idf)
    return scored.where("prediction = 1.0").select(F.col("_word").alias("word"))


def read_candidates(spark: SparkSession, path: str) -> DataFrame:
    """All candidates: word, batch_id. Batches that were summed up are read as one, of number -2."""
    rows = spark.read.schema(CANDIDATES).option("basePath", path).parquet(path)
    summed = commits.latest(spark, f"{path}/_commits")
    if summed is None:
        return rows
    base = spark.read.schema("word string").parquet(summed[1]["base"]).withColumn("batch_id", F.lit(-2).cast("bigint"))
    return rows.where(F.col("batch_id") > summed[1]["upto"]).unionByName(base)


def to_candidates(spark: SparkSession, load_lexicon: Callable[[], DataFrame], path: str, sum_every: int = 50) -> Keep:
    """Keep words for review: those neither listed nor candidates of another batch.

    Every ``sum_every`` batches the candidates of those before are written as one table, so that a batch meets no more
    folders than that, however long the stream runs. ``novelty`` tells new words without reading earlier ones at all.
    """
    spark.createDataFrame([], "word string").write.mode("overwrite").parquet(f"{path}/batch_id=-1")

    def keep(found: DataFrame, batch_id: int) -> None:
        if batch_id > 0 and batch_id % sum_every == 0:
            _sum_up(spark, path, batch_id - 1)
        known = read_candidates(spark, path).where(F.col("batch_id") != batch_id).select("word")
        new = found.join(load_lexicon().select("word"), "word", "left_anti").join(known, "word", "left_anti")
        new.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return keep


def _sum_up(spark: SparkSession, path: str, upto: int) -> None:
    """Write the candidates of the finished batches up to a number as one table, which readers find by a commit."""
    base = f"{path}/_base/upto={upto}"
    read_candidates(spark, path).where(F.col("batch_id") <= upto).select("word").distinct().write.mode("overwrite").parquet(base)
    known = commits.latest(spark, f"{path}/_commits")
    if known is None or known[1]["upto"] < upto:
        commits.put(spark, f"{path}/_commits", (known[0] if known else 0) + 1, {"base": base, "upto": upto})


def compact_candidates(spark: SparkSession, path: str, target: str) -> None:
    """Write the candidates of all batches as one set of files below ``target``, which then replaces ``path``.

    Each batch reads the candidates of the others, so a stream that has run long should not find a folder per batch.
    """
    read_candidates(spark, path).select("word").distinct().write.mode("overwrite").parquet(f"{target}/batch_id=-2")


def to_lexicon(spark: SparkSession, path: str, first_version: int, category: str = "discovered", writer: str = "discovery") -> Keep:
    """Take new words into a versioned lexicon at once; batch n becomes version ``first_version`` + n of this writer.

    Versions of the same number by other writers, such as a reviewer, stay.
    """

    def keep(found: DataFrame, batch_id: int) -> None:
        version = first_version + batch_id
        own = (F.col("version") == version) & (F.col("writer") == writer)
        others = lexicon.read_versions(spark, path, with_writer=True).where(~own)
        new = found.join(lexicon.current(others).select("word"), "word", "left_anti")
        lexicon.append_version(new.select("word", F.lit(category).alias("category"), F.lit("add").alias("op")), path, version, writer)

    return keep


def archive_batch(texts: DataFrame, path: str, topic: str, batch_id: int) -> None:
    """Keep the cleaned texts of a batch as lines of text files."""
    texts.select("text").write.mode("overwrite").text(f"{path}/topic={topic}/batch_id={batch_id}")


def message_texts(messages: DataFrame, value: str, path: Sequence[str] | None, profile: str | None) -> DataFrame:
    """Cleaned texts of the messages that have one: text. Without a path the message is the text."""
    text = F.col(value) if path is None else J.extract_strict(F.col(value), path)
    return messages.where(F.length(value) > 0).select(present(clean_text(text, profile)).alias("text"))


def discovery_stream(
    messages: DataFrame,
    model: PipelineModel | Callable[[], PipelineModel],
    keep: Keep,
    checkpoint: str,
    archive: str | None = None,
    topic: str = "messages",
    value: str = "value",
    path: Sequence[str] | None = J.DEFAULT_PATH,
    profile: str | None = "stream",
    ngrams: bool = False,
    refit_idf: bool = False,
    every: str | None = None,
    deal: bool = False,
) -> DataStreamWriter:
    """A stream that scores the words of each batch, hands the sensitive ones to ``keep`` and archives the texts.

    Each batch writes to folders of its own number, so one that is run again leaves no copy. Batches
    without a text write nothing. Instead of a model a function may be given that is asked for it at each batch, such as
    ``models.Newest``. ``deal`` deals the messages of a batch over the cores, for a source of fewer splits than cores.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        texts = message_texts(spread(batch) if deal else batch, value, path, profile).persist()
        try:
            if texts.isEmpty():
                return
            if archive:
                archive_batch(texts, archive, topic, batch_id)
            words = batch_words(texts, F.col("text"), ngrams)
            keep(predicted_sensitive(words, model if isinstance(model, PipelineModel) else model(), refit_idf), batch_id)
        finally:
            texts.unpersist()

    writer = messages.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
