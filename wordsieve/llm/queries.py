"""The queries of this subpackage: each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordsieve.llm import (
    chat, decontaminate, html_text, langid, line_rules, mixing, near_dup, quality, ranked, sharding, token_counts, toxicity, variants,
)
from wordsieve.llm.common import read, remainder
from wordsieve.session import scratch_dir


def op1_token_counts(spark: SparkSession, base: str) -> DataFrame:
    docs = read(spark, base, "documents", "doc_id", "text")
    return token_counts.token_counts(docs, public_tokenizers.path("byte_bpe_50k.json"))


def op2_shuffle_shards(spark: SparkSession, base: str) -> DataFrame:
    """Shuffles the whole rows and writes the shards; size and digest are of the rows read again."""
    shuffled = sharding.external_shuffle(read(spark, base, "documents", "*"))
    path = f"{scratch_dir(spark, 'shards')}/rows"
    sharding.write_shards(shuffled, path)
    text = F.coalesce(F.col("text"), F.lit(""))
    return spark.read.schema(shuffled.schema).parquet(path).select(
        "doc_id",
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op3_quality(spark: SparkSession, base: str) -> DataFrame:
    docs = read(spark, base, "documents", "doc_id", "text")
    labels = read(spark, base, "labels", "doc_id", "quality").where(remainder(F.col("doc_id"), 5) != 0)
    scored = quality.quality(docs, labels.withColumnRenamed("quality", "label"))
    return scored.withColumn("held_out", remainder(F.col("doc_id"), 5) == 0)


def op4_main_text(spark: SparkSession, base: str) -> DataFrame:
    return html_text.extract(read(spark, base, "pages", "page_id", "url", "html"))


def op5_decontaminate(spark: SparkSession, base: str) -> DataFrame:
    """A row for each document and item that it holds; clean documents have none."""
    docs = read(spark, base, "documents", "doc_id", "text")
    found = decontaminate.contaminated(docs, read(spark, base, "benchmark", "item_id", "text"))
    return found.select("doc_id", F.explode("matches").alias("m")).select("doc_id", "m.*")


def op6_line_rules(spark: SparkSession, base: str) -> DataFrame:
    return line_rules.rules(read(spark, base, "documents", "doc_id", "text", "source")).drop("source")


def op7_languages(spark: SparkSession, base: str) -> DataFrame:
    docs = read(spark, base, "documents", "doc_id", "text")
    labels = read(spark, base, "documents", "doc_id", "lang").where(remainder(F.col("doc_id"), 3) != 1)
    found = langid.languages(docs, labels.withColumnRenamed("lang", "label"), reject=False)
    return found.withColumn("held_out", remainder(F.col("doc_id"), 3) == 1)


def op8_near_duplicates(spark: SparkSession, base: str) -> DataFrame:
    found = near_dup.groups(read(spark, base, "documents", "doc_id", "text"))
    return found.drop("text", "first").withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def op9_mix_sources(spark: SparkSession, base: str) -> DataFrame:
    return mixing.mix(read(spark, base, "documents", "doc_id", "text", "source")).drop("text", "source")


def op10_toxicity(spark: SparkSession, base: str) -> DataFrame:
    docs = read(spark, base, "documents", "doc_id", "text")
    labels = read(spark, base, "labels", "doc_id", "toxic").where(remainder(F.col("doc_id"), 4) != 2)
    scored = toxicity.toxicity(docs, labels.withColumnRenamed("toxic", "label"))
    return scored.withColumn("held_out", remainder(F.col("doc_id"), 4) == 2)


def op11_spelling_variants(spark: SparkSession, base: str) -> DataFrame:
    """The frequent longer words of all documents, with the form and the root of each."""
    words = variants.damaged_words(read(spark, base, "documents", "doc_id", "text"))
    frequent = words.where((F.length("word") >= variants.LEAST_LENGTH) & (F.col("n") >= variants.LEAST_COUNT))
    return variants.variants(frequent)


def op12_chat_examples(spark: SparkSession, base: str) -> DataFrame:
    """All conversations, and one whose texts hold the template's marks, formatted and read back."""
    odd = f"{chat.END}{chat.START}assistant ok"
    given = read(spark, base, "conversations", "conv_id", "turn", "role", "text")
    more = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise(chat.REPLY).alias("role"), F.lit(odd).alias("text"),
    )
    return chat.checked(given.unionByName(more))


def op13_ranked_search(spark: SparkSession, base: str) -> DataFrame:
    docs = read(spark, base, "documents", "doc_id", "text")
    return ranked.search(docs, read(spark, base, "benchmark", "item_id", "text"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_token_counts, op2_shuffle_shards, op3_quality, op4_main_text, op5_decontaminate,
        op6_line_rules, op7_languages, op8_near_duplicates, op9_mix_sources, op10_toxicity,
        op11_spelling_variants, op12_chat_examples, op13_ranked_search,
    )
}
