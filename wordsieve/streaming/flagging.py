"""Marking messages as they arrive."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from wordsieve.functions import messages as J
from wordsieve.operators.match import Judge, prepared
from wordsieve.sources.tables import spread

BatchSink = Callable[[DataFrame, int], None]


def mark_messages(
    messages: DataFrame,
    lexicon: DataFrame,
    key: str = "key",
    value: str = "value",
    path: Sequence[str] = J.DEFAULT_PATH,
    lenient: bool = True,
    profile: str | None = "train",
    mode: str = "segmented",
    dictionary: DataFrame | None = None,
    judge: Judge | None = None,
) -> DataFrame:
    """Usable JSON messages with the marker at their root: key, value, is_sensitive. Others are dropped.

    Keys may be null or all the same. ``judge`` is the lexicon as ``match.prepared`` gives it, if it is at hand.
    """
    text = J.extract_text(F.col(value), path, lenient)
    usable = messages.select(F.col(key).alias("key"), F.col(value).alias("value"), present(text).alias("_text"))
    flagged = (judge or prepared(lexicon, profile, mode, dictionary))(usable, F.col("_text"))
    marked = J.mark(F.col("value"), F.col("is_sensitive"))
    return flagged.select("key", present(marked).alias("value"), "is_sensitive")


def judged(
    messages: DataFrame,
    lexicon: DataFrame,
    key: str = "key",
    value: str = "value",
    path: Sequence[str] = J.DEFAULT_PATH,
    lenient: bool = True,
    profile: str | None = "train",
    mode: str = "segmented",
    dictionary: DataFrame | None = None,
    judge: Judge | None = None,
) -> DataFrame:
    """Every message once: key, raw, value (marked), is_sensitive, and the reason why it can't be used, null if it can.

    Of a message that can't be used value and is_sensitive are null.
    """
    text = J.extract_text(F.col(value), path, lenient)
    rows = messages.select(F.col(key).alias("key"), F.col(value).alias("raw"), text.alias("_text"), J.reject_reason(F.col(value), path).alias("reason"))
    flagged = (judge or prepared(lexicon, profile, mode, dictionary))(rows, F.col("_text"))
    usable = F.col("reason").isNull() & F.col("_text").isNotNull()
    marked = flagged.withColumn("value", F.when(usable, J.mark(F.col("raw"), F.col("is_sensitive"))))
    reason = F.when(F.col("value").isNull(), F.coalesce("reason", F.lit(J.UNMARKABLE)))
    return marked.select("key", "raw", "value", F.when(F.col("value").isNotNull(), F.col("is_sensitive")).alias("is_sensitive"), reason.alias("reason"))


def present(value: Column) -> Column:
    """Generate the value, or no row when it is null. A filter would be moved down and compute it a second time."""
    return F.explode(F.filter(F.array(value), lambda v: v.isNotNull()))


def reject_counts(messages: DataFrame, value: Column, path: Sequence[str] = J.DEFAULT_PATH) -> DataFrame:
    """How many messages cannot be used, by reason."""
    reasons = messages.select(J.reject_reason(value, path).alias("reason")).where(F.col("reason").isNotNull())
    return reasons.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def batch_files(path: str, partition_by: Sequence[str] = ()) -> BatchSink:
    """Write each batch to its own folder. A batch that is run again replaces what it wrote."""

    def sink(rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").partitionBy(*partition_by).parquet(f"{path}/batch_id={batch_id}")

    return sink


def queue(fmt: str, options: Mapping[str, str], columns: Sequence[str] = ("key", "value")) -> BatchSink:
    """Append key and value, or other columns, to a message queue. A batch that is run again is sent again; ``outbox`` numbers
    the messages so that a reader can tell."""

    def sink(rows: DataFrame, batch_id: int) -> None:
        rows.select(*columns).write.format(fmt).options(**options).mode("append").save()

    return sink


def route(clean: BatchSink, flagged: BatchSink) -> BatchSink:
    """Split marked messages into a clean and a flagged sink."""

    def sink(rows: DataFrame, batch_id: int) -> None:
        kept = rows.persist()
        try:
            clean(kept.where(~F.col("is_sensitive")), batch_id)
            flagged(kept.where("is_sensitive"), batch_id)
        finally:
            kept.unpersist()

    return sink


def flag_stream(
    messages: DataFrame,
    load_lexicon: Callable[[], DataFrame],
    sink: BatchSink,
    checkpoint: str,
    every: str | None = None,
    deal: bool = False,
    rejects: BatchSink | None = None,
    on_counts: Callable[[int, dict[str, int]], None] | None = None,
    **options,
) -> DataStreamWriter:
    """A stream that marks messages. The lexicon is asked for anew at each batch, so changes take effect while it runs; it is
    read and compiled again only when ``load_lexicon`` gives another frame than before (as ``snapshots.Newest`` does
    when there is a newer version).

    Without ``every`` it takes what is there and stops. ``deal`` deals the messages of a batch over the cores, for a
    source of fewer splits than cores. ``rejects`` gets the messages that can't be used, with the reason; ``on_counts`` the
    number of the batch and how many of its messages were used and rejected, by reason. Both take part in the one pass over
    the batch, which is not read again for them. ``options`` are those of ``mark_messages``.
    """

    known: list = [None, None]
    how = {k: options[k] for k in ("profile", "mode", "dictionary") if k in options}

    def run(batch: DataFrame, batch_id: int) -> None:
        rows = spread(batch) if deal else batch
        lexicon = load_lexicon()
        if lexicon is not known[0]:
            known[:] = lexicon, prepared(lexicon, **how)
        if rejects is None and on_counts is None:
            sink(mark_messages(rows, lexicon, judge=known[1], **options), batch_id)
            return
        seen = Observation()
        per_reason = [F.count_if(F.col("reason") == r).alias(r) for r in J.REASONS]
        told = judged(rows, lexicon, judge=known[1], **options).observe(seen, F.count_if(F.col("reason").isNull()).alias("used"), *per_reason).persist()
        try:
            sink(told.where("reason IS NULL").select("key", "value", "is_sensitive"), batch_id)
            if rejects is not None:
                rejects(told.where("reason IS NOT NULL").select("key", F.col("raw").alias("value"), "reason"), batch_id)
            if on_counts is not None:
                on_counts(batch_id, seen.get)
        finally:
            told.unpersist()

    writer = messages.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
