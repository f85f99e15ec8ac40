"""Mixing sources to target weights: whole repetitions plus one hash-seeded Bernoulli copy."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordsieve.llm.common import WORD, quoted, without
from wordsieve.session import stored

# Fixed by the task: weights by place of the source in code-point order, repeating; targets stop at this many sizes.
WEIGHTS = (5, 2, 1)
MOST_COPIES = 3

# The draws of a source are summed in this many equal slices of the hash, from which its threshold comes.
SLICES = 4096
DRAWS = 1 << 32


def word_count(text: Column) -> Column:
    """Runs of characters that are no white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """``target`` and ``rate`` for each row of (source, source_size).

    The total of all sizes is shared by weight. A share above ``most`` times its source's size stops there and
    the excess is shared again among the rest, until none is above: sources reach their limit in the order of
    limit over weight, so each level is a running sum over the table of sources. That table has a row per
    corpus, not per document, so its windows stay small. A source of no words has target and rate 0.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").isNull(), F.encode(F.col("source"), "utf-8"))) - 1
    listed = F.array(*[F.lit(w).cast("long") for w in weights])
    weighted = sizes.withColumn("weight", F.element_at(listed, (place % len(weights) + 1).cast("int"))).withColumn(
        "limit", F.col("source_size") * most
    )
    order = [F.col("limit") / F.col("weight"), F.col("source").isNull(), F.encode(F.col("source"), "utf-8")]
    before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rest = Window.orderBy(*order).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    levels = (
        weighted.withColumn("left", F.sum("source_size").over(whole) - F.coalesce(F.sum("limit").over(before), F.lit(0)))
        .withColumn("open", F.sum("weight").over(rest))
        # The source stays at its limit when the level of those still open is above it.
        .withColumn("full", F.col("left") * F.col("weight") >= F.col("limit") * F.col("open"))
    )
    first = F.first(F.when(~F.col("full"), F.struct("left", "open")), ignorenulls=True).over(Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    target = F.when(F.col("full"), F.col("limit").cast("double")).otherwise(
        (F.col("weight") * F.col("level.left")).cast("double") / F.col("level.open").cast("double")
    )
    return (
        levels.withColumn("level", first)
        .withColumn("target", target)
        .withColumn("rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0)))
        .select("source", "source_size", "target", "rate")
    )


def draw(seed: int, *keys: Column) -> Column:
    """A number from 0 to 2^32 - 1 from the md5 of the seed and the keys; a null key counts as an empty text."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(k.cast("string"), F.lit("")) for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def mix(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[int] = WEIGHTS,
    most: int = MOST_COPIES,
    seed: int = 17,
) -> DataFrame:
    """How often each document is taken: its columns, and size, source_size, target, copies, taken.

    Each document is taken floor(rate) times, and once more if its draw is below the threshold of its source. The
    threshold is the rate's fraction, moved to the slice of the hash where the draws of the source have gathered
    the words that the fraction asks for: a small source with few long documents would miss its target by
    chance otherwise, and for a large one the two agree. The slices are pre-aggregated sums, so a source with a
    third of all rows weighs no more than another, and the table that is joined back has a row per source.

    Null or empty text has size 0 and is taken like any other, 0 words. Null sources form one source, the last.
    Documents that agree in id and text draw alike. An empty table gives an empty result.
    """
    added = ["size", "source_size", "target", "copies", "taken"]
    kept = without(docs, *added)
    sized = docs.select(
        *[quoted(c) for c in kept],
        word_count(quoted(text)).alias("size"),
        quoted(source).alias("_source"),
        draw(seed, quoted(doc_id), F.md5(F.coalesce(quoted(text), F.lit("")).cast("binary"))).alias("_draw"),
    )
    slice_of = F.floor(F.col("_draw") / (DRAWS // SLICES)).cast("int")
    sums = sized.groupBy(F.col("_source").alias("source"), slice_of.alias("slice")).agg(F.sum("size").alias("words"))
    plan = targets(sums.groupBy("source").agg(F.sum("words").alias("source_size")), weights, most)
    wanted = F.col("target") - F.floor(F.col("rate")) * F.col("source_size")
    upto = Window.partitionBy("source").orderBy("slice")
    # The threshold lies after the slice that brings the sum nearest to what is wanted; before all if none is nearer.
    nearest = (
        sums.join(plan, sums.source.eqNullSafe(plan.source)).drop(plan.source)
        .withColumn("gap", F.abs(F.sum("words").over(upto) - wanted))
        .groupBy("source", "source_size", "target", "rate")
        .agg(F.min(F.struct("gap", "slice")).alias("best"))
        .select(
            F.col("source").alias("_key"),
            "source_size",
            "target",
            F.floor("rate").alias("_whole"),
            F.when(F.col("best.gap") < wanted, F.col("best.slice") + 1).otherwise(0).alias("_slices"),
        )
    )
    # Written first, so that the join knows its size: broadcast while it is small, else shuffled.
    nearest = stored(nearest, "mixing-plan")
    joined = sized.join(nearest, F.col("_source").eqNullSafe(F.col("_key")))
    extra = (slice_of < F.col("_slices")).cast("int")
    return (
        joined.withColumn("copies", (F.col("_whole") + extra).cast("int"))
        .withColumn("taken", F.col("copies") * F.col("size"))
        .select(*[quoted(c) for c in kept], *added)
    )


def emit(mixed: DataFrame, copies: str = "copies") -> DataFrame:
    """Each row as often as it is taken."""
    return mixed.withColumn("_copy", F.explode(F.array_repeat(F.lit(1), quoted(copies)))).drop("_copy")
