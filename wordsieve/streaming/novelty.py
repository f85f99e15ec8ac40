"""Which words of a stream are seen for the first time, as keyed state instead of a look at all earlier batches."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from wordsieve.session import share_package

# Fixed value: the store that keyed state of this kind needs.
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class FirstSeen(StatefulProcessor):
    """Gives a word when its key has no state yet. With a time to live a word counts as new again when it has not been met that long."""

    def __init__(self, ttl_ms: int | None = None):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "known boolean", self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802, N803
        new = not self.seen.exists()
        if new or self.ttl_ms:
            self.seen.update((True,))
        if new:
            yield Row(word=key[0])

    def handleInitialState(self, key, initialState, timerValues) -> None:  # noqa: N802, N803
        self.seen.update((True,))


def once_per_batch(words: DataFrame) -> DataFrame:
    """Drop repetitions of a word inside each Arrow batch, so that a frequent word goes to its key a few times only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0).unique()], names=["word"])

    return words.select("word").mapInArrow(run, "word string")


def new_words(words: DataFrame, known: DataFrame | None = None, ttl_ms: int | None = None) -> DataFrame:
    """The words of a stream (word) when they are first met: word. Each comes once, whatever is restarted or retried.

    State is kept by word in the checkpoint's store: it grows with the vocabulary, not with the batches, and no batch
    reads what earlier ones wrote. Words ``known`` when the stream first starts are in the state from then on; the
    table is not read again. ``ttl_ms`` bounds the state by forgetting words. The session needs the store named by
    ``STORE``.
    """
    spark = words.sparkSession
    share_package(spark)
    if spark.conf.get("spark.sql.streaming.stateStore.providerClass") != STORE:
        raise ValueError(f"set spark.sql.streaming.stateStore.providerClass to {STORE}")
    initial = None if known is None else known.select("word").where(F.col("word").isNotNull()).distinct().groupBy("word")
    present = once_per_batch(words.where(F.col("word").isNotNull()))
    mode = "ProcessingTime" if ttl_ms else "None"
    return present.groupBy("word").transformWithState(FirstSeen(ttl_ms), "word string", "Append", mode, initial)
