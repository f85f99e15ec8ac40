"""Benchmark passages in documents: SimHash windows of the items' size, found by Hamming blocks, then verified."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wordsieve.llm.common import map_text, quoted, without
from wordsieve.llm.words import PRIME, mix, shingles, word_hashes
from wordsieve.session import stored

SHINGLE = 5
SIMILARITY = 0.8

# A fingerprint of 64 bits is cut into BLOCKS parts. Of two that differ in RADIUS bits at most, one part differs in
# FLIPS at most, so looking each part up with up to FLIPS bits changed misses none.
BLOCKS, BLOCK_BITS, FLIPS = 4, 16, 2
RADIUS = BLOCKS * (FLIPS + 1) - 1

# Windows take this share of an item, from its head and from its tail, rounded down to sizes that grow by STEP.
SHARE, STEP = 0.85, 1.3

# Words that are fingerprinted at once, and bytes of index that one pass over the documents compares.
SLICE = 1 << 15
INDEX_BYTES = 64 << 20

# What an item of any length takes in the index: two windows, each under every part with every flip, and its arrays.
FLIPPED = 1 + BLOCK_BITS + BLOCK_BITS * (BLOCK_BITS - 1) // 2
ENTRY_BYTES = 2 * BLOCKS * FLIPPED * 4 + 512

MATCH = T.StructType(
    [
        T.StructField("item_id", T.LongType()),
        T.StructField("begin", T.LongType()),
        T.StructField("end", T.LongType()),
        T.StructField("similarity", T.DoubleType()),
    ]
)


GRAMS = T.StructType([T.StructField("grams", T.ArrayType(T.LongType()))])


def window_size(words: int) -> int:
    """The window for an item of so many words, on a grid that keeps the number of sizes low."""
    size = SHINGLE
    while (larger := max(size + 1, int(size * STEP))) <= max(SHINGLE, words * SHARE):
        size = larger
    return size


def fingerprints(words: np.ndarray, sizes: Sequence[int]) -> Iterator[tuple[int, np.ndarray]]:
    """For each size the SimHash of every window of so many words; its features are the pairs of adjacent words."""
    pairs = mix(words[:-1] * PRIME + words[1:])
    kind = np.int8 if max(sizes) < 128 else np.int32
    votes = np.unpackbits(pairs.view(np.uint8)).reshape(-1, 64).astype(kind) * kind(2) - kind(1)
    # Sums may wrap around; the difference of two is right while a window has fewer words than the type holds.
    running = np.zeros((len(votes) + 1, 64), kind)
    np.cumsum(votes, axis=0, dtype=kind, out=running[1:])
    for size in sizes:
        if len(words) >= size:
            yield size, np.packbits(running[size - 1 :] - running[: 1 - size] > 0, axis=1).view(np.uint64).ravel()


def item_shingles(texts: Sequence[str | None]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Row, words and sorted distinct shingles of each item that is looked for: shorter ones hold no shingle."""
    for row, words in word_hashes(texts, plain=True):
        if len(words) >= SHINGLE:
            yield row, words, np.unique(shingles(words, SHINGLE))


def shared_shingles(items: DataFrame) -> DataFrame:
    """The shingles (block, gram) of the items (block, text) that items of different shingles share, with the number of their
    holders among the items of all blocks."""

    def grams(texts: Sequence[str | None]) -> list[pa.Array]:
        found: list = [[] for _ in texts]
        for row, _, own in item_shingles(texts):
            found[row] = own.view(np.int64)
        return [pa.array(found, pa.list_(pa.int64()))]

    held = map_text(items.select("block", "text").distinct(), "text", GRAMS, lambda: grams)
    holders = held.select("grams").distinct().select(F.explode("grams").alias("gram")).groupBy("gram").agg(F.count(F.lit(1)).alias("holders"))
    return held.select("block", F.explode("grams").alias("gram")).distinct().join(holders.where("holders > 1"), "gram")


class Index:
    """Fingerprints of the items by window size, looked up by parts.

    ``holders`` has the shingles (sorted) that several items hold, and how many; without it they are counted among ``items``.
    """

    def __init__(self, items: Sequence[tuple[int, str]], similarity: float, holders: tuple[np.ndarray, np.ndarray] | None = None):
        self.similarity = similarity
        self.ids, self.words, self.shingles = [], [], []
        for row, words, own in item_shingles([t for _, t in items]):
            self.ids.append(items[row][0])
            self.words.append(words)
            self.shingles.append(own)
        if holders is None:
            # Items of the same shingles are one holder.
            distinct = {own.tobytes(): own for own in self.shingles}
            holders = np.unique(np.concatenate([np.zeros(0, np.uint64), *distinct.values()]), return_counts=True)
        # A shingle weighs less the more items share it.
        values, many = np.append(holders[0], np.uint64(0)), np.append(holders[1], 1)
        self.weights = []
        for own in self.shingles:
            place = np.searchsorted(values[:-1], own)
            self.weights.append(1.0 / np.where(values[place] == own, many[place], 1))
        groups: dict[int, list[tuple[int, int]]] = {}
        for k, words in enumerate(self.words):
            size = window_size(len(words))
            for offset in {0, len(words) - size}:
                groups.setdefault(size, []).append((k, offset))
        masks = [0, *(1 << a for a in range(BLOCK_BITS)), *(1 << a | 1 << b for a in range(BLOCK_BITS) for b in range(a))]
        self.tables = {}
        for size, members in sorted(groups.items()):
            prints = np.array([next(fingerprints(self.words[k][o : o + size], [size]))[1][0] for k, o in members], np.uint64)
            parts = prints.view(np.uint16).reshape(-1, BLOCKS)
            lookups = []
            for b in range(BLOCKS):
                keys = (parts[:, b, None] ^ np.array(masks, np.uint16)).ravel()
                order = np.argsort(keys, kind="stable")
                first = np.searchsorted(keys[order], np.arange((1 << BLOCK_BITS) + 1)).astype(np.int32)
                # The member of an entry, of which each has one for every mask.
                lookups.append((np.diff(first) > 0, first, (order // len(masks)).astype(np.int32)))
            item, offset = np.array(members).T
            self.tables[size] = (prints, item, offset, lookups)
        self.longest = max((len(w) for w in self.words), default=0)

    def candidates(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(item, start) of all windows within RADIUS of an item's, start being where the whole item would begin."""
        found = [np.zeros((2, 0), np.int64)]
        for size, prints in fingerprints(words, list(self.tables)):
            own, item, offset, lookups = self.tables[size]
            parts = prints.view(np.uint16).reshape(-1, BLOCKS)
            for b, (filled, first, entries) in enumerate(lookups):
                at = np.flatnonzero(filled[parts[:, b]])
                key = parts[at, b].astype(np.int64)
                begin = first[key].astype(np.int64)
                many = first[key + 1] - begin
                place = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
                entry = entries[np.repeat(begin, many) + place]
                at = np.repeat(at, many)
                near = np.bitwise_count(prints[at] ^ own[entry]) <= RADIUS
                found.append(np.stack([item[entry[near]], at[near] - offset[entry[near]]]))
        return tuple(np.unique(np.concatenate(found, 1), axis=1))

    def similar(self, item: int, words: np.ndarray) -> float:
        """Jaccard similarity of the five-word shingles of an item and of a window, weighted or plain: the larger one.

        Shingles that the item lacks weigh what those do, on average, whose place they take, so the other items count
        only by the weights of the item's own shingles.
        """
        if len(words) < SHINGLE:
            return 0.0
        own, weight, other = self.shingles[item], self.weights[item], np.unique(shingles(words, SHINGLE))
        place = np.minimum(np.searchsorted(own, other), len(own) - 1)
        place = place[own[place] == other]
        lost, new = len(own) - len(place), len(other) - len(place)
        shared = weight[place].sum()
        gone = weight.sum() - shared if lost else 0.0
        whole = shared + gone + new * (gone / lost if lost else weight.mean())
        return float(max(shared / whole, len(place) / (len(own) + new)))

    def search(self, texts: Sequence[str | None]) -> list[list[dict]]:
        """For each text the items it holds: item, first word and word past the end, similarity; by item."""
        best: list[dict[int, tuple]] = [{} for _ in texts]
        if self.tables:
            held, size = [], 0
            for row, words in word_hashes(texts, plain=True):
                # Slices of a long text overlap by the longest item.
                for begin in range(0, max(1, len(words) - self.longest), SLICE):
                    held.append((row, begin, words, min(len(words), begin + SLICE + self.longest)))
                    size += held[-1][3] - begin
                    if size >= SLICE:
                        self.compare(held, best)
                        held, size = [], 0
            self.compare(held, best)
        return [[{"item_id": self.ids[k], "begin": b, "end": e, "similarity": s} for k, (s, b, e) in sorted(found.items())] for found in best]

    def compare(self, held: list[tuple], best: list[dict[int, tuple]]) -> None:
        if not held:
            return
        joined = np.concatenate([words[begin:end] for _, begin, words, end in held])
        edges = np.cumsum([0, *[end - begin for _, begin, _, end in held]])
        if len(joined) < 2:
            return
        for item, start in zip(*self.candidates(joined)):
            # The middle of the item tells which text it lies in.
            k = int(np.searchsorted(edges, max(0, start + len(self.words[item]) // 2), "right")) - 1
            if k >= len(held):
                continue
            row, begin, words, _ = held[k]
            first = max(0, int(start - edges[k]) + begin)
            last = min(len(words), int(start - edges[k]) + begin + len(self.words[item]))
            value = self.similar(item, words[first:last])
            if value >= self.similarity and value > best[row].get(item, (0,))[0]:
                best[row][int(item)] = (value, first, last)


def contaminated(docs: DataFrame, items: DataFrame, text: str = "text", similarity: float = SIMILARITY, keep_text: bool = False) -> DataFrame:
    """The columns of ``docs`` with ``matches``, the items (item_id, text) that each whole text holds.

    A match is a run of words, as many as the item has, whose five-word shingles, plain or weighted, reach ``similarity``.
    Words are lower-case and parted by white space and ASCII marks. The items are measured by what they take in the index
    (their bytes eight times over for words and shingles, and ENTRY_BYTES each) and go to the tasks in blocks of about INDEX_BYTES; each block is one pass over the documents, without a shuffle of them while there is one block. A
    shingle's holders are counted over all items, so the matches don't depend on the blocks.

    Null and empty texts hold nothing. Items of null or fewer than five words are not looked for; equal items are
    all reported. Repeated rows are judged alike; empty tables give no rows and no matches.
    """
    spark = docs.sparkSession
    known = items.select(F.col("item_id").cast("long"), F.col("text")).where(F.col("text").isNotNull())
    held = known.agg(F.coalesce(F.sum(8 * F.octet_length("text") + ENTRY_BYTES), F.lit(0))).first()[0]
    blocks = max(1, -(-held // INDEX_BYTES))
    known = known.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)))
    shared = stored(shared_shingles(known), "decontaminate-shingles")
    out = T.StructType([T.StructField("matches", T.ArrayType(MATCH))])

    def search(rows: DataFrame, block: int) -> DataFrame:
        own = [tuple(r) for r in known.where(F.col("block") == block).select("item_id", "text").orderBy("item_id", "text").collect()]
        held = shared.where(F.col("block") == block).select("gram", "holders").toArrow()
        values, many = held["gram"].to_numpy().view(np.uint64), held["holders"].to_numpy()
        order = np.argsort(values)
        index = spark.sparkContext.broadcast(Index(own, similarity, (values[order], many[order])))
        kind = pa.list_(pa.struct([("item_id", pa.int64()), ("begin", pa.int64()), ("end", pa.int64()), ("similarity", pa.float64())]))
        return map_text(rows, "_t", out, lambda: lambda texts: [pa.array(index.value.search(texts), kind)], True)

    kept = without(docs, "matches", *([] if keep_text else [text]))
    rows = docs.select(*[quoted(c) for c in kept], quoted(text).alias("_t"))
    if blocks == 1:
        return search(rows, 0).select(*[quoted(c) for c in kept], "matches")
    rows = stored(rows.withColumn("_row", F.monotonically_increasing_id()), "decontaminate")
    found = None
    for block in range(blocks):
        part = search(rows.select("_row", "_t"), block).where(F.size("matches") > 0).select("_row", F.explode("matches").alias("m"))
        found = part if found is None else found.unionByName(part)
    gathered = found.groupBy("_row").agg(F.sort_array(F.collect_list("m")).alias("matches"))
    none = F.array().cast(T.ArrayType(MATCH))
    return rows.join(gathered, "_row", "left").select(*[quoted(c) for c in kept], F.coalesce("matches", none).alias("matches"))
