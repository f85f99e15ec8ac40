"""Ranked search of many items in all documents: an index of the items, through which the documents stream."""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wordsieve.llm.common import map_text, quoted
from wordsieve.session import stored

TOP = 10

# Bytes of the index of one block of items, as measured from its postings.
INDEX_BYTES = 64 << 20
POSTING_BYTES = 8
TERM_BYTES = 160

# Documents x items whose scores a task holds at a time.
CELLS = 1 << 20

# A-Z lowered; ASCII other than letters and digits parts terms. Bytes of all other characters belong to terms.
TERMS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def terms(text: str | None) -> list[bytes]:
    return text.encode().translate(TERMS).split() if text else []


class Index:
    """Postings of a block of items: for every term the items that hold it."""

    def __init__(self, postings: Sequence[tuple[int | None, bytes]]):
        ids = sorted({i for i, _ in postings}, key=lambda i: (i is None, i or 0))
        place = {i: k for k, i in enumerate(ids)}
        self.items = ids
        self.number: dict[bytes, int] = {}
        for _, t in postings:
            self.number.setdefault(t, len(self.number))
        term = np.array([self.number[t] for _, t in postings], np.int64)
        item = np.array([place[i] for i, _ in postings], np.int32)
        order = np.lexsort((item, term))
        self.item = item[order]
        self.first = np.searchsorted(term[order], np.arange(len(self.number) + 1))
        self.weight = np.zeros(len(self.number), np.int64)
        self.documents = self.length = 0

    def weigh(self, counts: dict[int, int], documents: int, length: int) -> None:
        """Weights of the terms by the number of documents that hold each."""
        self.documents, self.length = documents, length
        for k, df in counts.items():
            self.weight[k] = math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))

    def found(self, text: str | None) -> tuple[int, list[tuple[int, int]]]:
        """How many terms a text has, and (term, occurrences) of those that the items hold."""
        own = terms(text)
        number = self.number
        return len(own), [(number[t], c) for t, c in Counter(own).items() if t in number]


class Heaps:
    """The best documents of each item so far."""

    def __init__(self, index: Index, top: int):
        self.index, self.top = index, top
        self.heaps: list[list[tuple]] = [[] for _ in index.items]
        # No score below an item's bound can enter its heap.
        self.bound = np.ones(len(index.items), np.int64)
        self.ids: list[int | None] = []
        self.m: list[int] = []
        self.hits: list[list[tuple[int, int]]] = []
        self.postings = 0

    def add(self, doc_id: int | None, text: str | None) -> None:
        n, hits = self.index.found(text)
        if not hits:
            return
        self.ids.append(doc_id)
        self.m.append(10 + 90 * n * self.index.documents // self.index.length)
        self.hits.append(hits)
        self.postings += int(sum(self.index.first[t + 1] - self.index.first[t] for t, _ in hits))
        if max(len(self.ids) * len(self.heaps), self.postings) >= CELLS:
            self.score()

    def score(self) -> None:
        """Scores of the documents held, in whole numbers, and those that enter the heaps."""
        if not self.ids:
            return
        index, many = self.index, [len(h) for h in self.hits]
        doc = np.repeat(np.arange(len(self.ids)), many)
        term, tf = np.array([h for hits in self.hits for h in hits], np.int64).T
        m = np.array(self.m, np.int64)[doc]
        gain = index.weight[term] * (1_000_000_000 * tf // (1000 * tf + 8 * m))
        width = index.first[term + 1] - index.first[term]
        at = np.arange(width.sum()) - np.repeat(np.cumsum(width) - width, width) + np.repeat(index.first[term], width)
        scores = np.zeros((len(self.ids), len(self.heaps)), np.int64)
        np.add.at(scores, (np.repeat(doc, width), index.item[at]), np.repeat(gain, width))
        rows, items = np.nonzero(scores >= self.bound)
        for k, i, score in zip(rows.tolist(), items.tolist(), scores[rows, items].tolist()):
            heap = self.heaps[i]
            # Of equal scores the lower id is better, and no id the worst.
            entry = (score, -math.inf if self.ids[k] is None else -self.ids[k])
            if len(heap) < self.top:
                heapq.heappush(heap, entry)
            elif entry > heap[0]:
                heapq.heapreplace(heap, entry)
        self.bound = np.array([h[0][0] if len(h) == self.top else 1 for h in self.heaps], np.int64)
        self.ids, self.m, self.hits, self.postings = [], [], [], 0

    def rows(self) -> Iterator[tuple]:
        self.score()
        for item, heap in zip(self.index.items, self.heaps):
            for score, minus in heap:
                yield item, None if minus == -math.inf else -minus, score


COUNTS = T.StructType([T.StructField("term", T.LongType()), T.StructField("n", T.LongType())])
SCORES = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("doc_id", T.LongType()), T.StructField("score", T.LongType())])
ITEM_TERMS = T.StructType([T.StructField("terms", T.ArrayType(T.BinaryType()))])

# Fixed keys of the two sums that are counted beside the terms.
DOCUMENTS, LENGTH = -1, -2


def count_terms(docs: DataFrame, index) -> tuple[dict[int, int], int, int]:
    """Documents that hold each term of a broadcast index, documents with any term, and all their terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: Counter = Counter()
        for batch in batches:
            for text in batch.column(1).to_pylist():
                n, hits = index.value.found(text)
                if n:
                    own[DOCUMENTS] += 1
                    own[LENGTH] += n
                    own.update(t for t, _ in hits)
        if own:
            yield pa.RecordBatch.from_arrays([pa.array(list(own), pa.int64()), pa.array(list(own.values()), pa.int64())], names=COUNTS.fieldNames())

    counts = {r.term: r.n for r in docs.mapInArrow(run, COUNTS).groupBy("term").agg(F.sum("n").alias("n")).collect()}
    return counts, counts.pop(DOCUMENTS, 0), counts.pop(LENGTH, 0)


def best(docs: DataFrame, index, top: int) -> DataFrame:
    """The heaps of each task: item_id, doc_id, score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps = Heaps(index.value, top)
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                heaps.add(doc_id, text)
        rows = list(heaps.rows())
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=SCORES.fieldNames())

    return docs.mapInArrow(run, SCORES)


def ranked(found: DataFrame, top: int, *by: str) -> DataFrame:
    order = Window.partitionBy("item_id", *by).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def search(
    docs: DataFrame, items: DataFrame, top: int = TOP, doc_id: str = "doc_id", text: str = "text", index_bytes: int = INDEX_BYTES
) -> DataFrame:
    """The ``top`` documents of each item (item_id, text) by score: item_id, rank, doc_id, score.

    Reversed search: the items' terms become an index that goes to every task; the documents stream through it, and the
    terms of each raise the scores of the items that hold them. A task keeps a bounded heap for each item; the heaps are
    merged in two steps, so that no task meets those of all. One pass before counts the documents that hold each
    term. Scores are sums of whole numbers, so the order of adding doesn't matter.

    Items are measured by their postings and dealt by id into blocks of about ``index_bytes``; each block is two passes
    over the documents. The terms of one item must fit in a block twice over, else a ValueError is raised.

    Rows of one item id are one item of all their terms; items without a term have no rows, and a null id is an id.
    Null and empty texts have no terms and count nowhere. Rows that repeat an id are documents of their own, each with
    a rank. Ids are whole numbers; null ones come last among equal scores. Other columns are left out; empty tables
    give no rows.
    """
    spark = docs.sparkSession
    rows = docs.select(quoted(doc_id).cast("long").alias("doc_id"), quoted(text).alias("text"))
    asked = items.select(quoted("item_id").cast("long").alias("item_id"), quoted("text").alias("text"))
    split = lambda texts: [pa.array([sorted(set(terms(t))) for t in texts], pa.list_(pa.binary()))]
    postings = stored(map_text(asked, "text", ITEM_TERMS, lambda: split).select("item_id", F.explode("terms").alias("term")).distinct(), "ranked-terms")
    weight = F.sum(F.octet_length("term") + POSTING_BYTES + TERM_BYTES)
    held, largest = postings.groupBy("item_id").agg(weight.alias("b")).agg(F.coalesce(F.sum("b"), F.lit(0)), F.coalesce(F.max("b"), F.lit(0))).first()
    if largest > 2 * index_bytes:
        raise ValueError("an item has more terms than a block of the index may hold")
    blocks = -(-held // index_bytes)
    found = None
    for block in range(blocks):
        own = postings.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block)
        index = Index([(r.item_id, bytes(r.term)) for r in own.collect()])
        if not index.items:
            continue
        counts, documents, length = count_terms(rows, spark.sparkContext.broadcast(index))
        index.weigh(counts, documents, length)
        part = best(rows, spark.sparkContext.broadcast(index), top)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = spark.createDataFrame([], SCORES)
    once = ranked(found.withColumn("_task", F.pmod(F.spark_partition_id(), F.lit(64))), top, "_task").drop("rank", "_task")
    return ranked(once, top).select("item_id", "rank", "doc_id", "score")
