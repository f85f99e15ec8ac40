"""Near-duplicate groups by HyperMinHash sketches, banding and exact verification."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wordsieve.llm.common import map_text, quoted, without
from wordsieve.llm.graph import components
from wordsieve.llm.words import mix, shingles, word_hashes
from wordsieve.session import stored

SHINGLE = 4
SIMILARITY_PERCENT = 80

# Registers of a sketch; one holds a count of leading zeros (6 bits) and MANTISSA bits of the least hash of its bucket.
REGISTERS = 128
BUCKET_BITS = 7
MANTISSA = 10
# Registers to a band: four of 16 bits fill one long. At a similarity of 0.8 the 32 bands miss 5 pairs in 10^8.
BAND = 4

# Pairs are verified when the sketches put them within this of the similarity; small sets are always verified.
MARGIN = 0.25
SMALL_SET = 48

# Rows of a block whose pairs one task compares.
BLOCK = 256

# The order in which the empty registers ask the others: a permutation for each, from a fixed seed.
PROBES = np.stack([np.random.Generator(np.random.PCG64([7, k])).permutation(REGISTERS) for k in range(REGISTERS)])


def registers(hashes: np.ndarray) -> np.ndarray:
    """The registers of a sorted set of hashes: the bucket is in the top bits, the rest is compared.

    The least of each bucket is kept as its leading zeros and the bits behind the first one. An empty
    bucket takes the register of the first filled bucket that its probes meet.
    """
    found, first = np.unique(hashes >> np.uint64(64 - BUCKET_BITS), return_index=True)
    # 52 bits are exact in a double, whose exponent gives the leading zeros.
    least = (hashes[first] << np.uint64(BUCKET_BITS)) >> np.uint64(12)
    zeros = 52 - np.frexp(least.astype(np.float64))[1]
    mantissa = ((least << zeros.astype(np.uint64)) >> np.uint64(51 - MANTISSA)) & np.uint64((1 << MANTISSA) - 1)
    out = np.zeros(REGISTERS, np.uint16)
    out[found] = (zeros << MANTISSA) | mantissa.astype(np.int64)
    if len(found) < REGISTERS:
        filled = np.zeros(REGISTERS, bool)
        filled[found] = True
        empty = np.flatnonzero(~filled)
        out[empty] = out[PROBES[empty, filled[PROBES[empty]].argmax(1)]]
    return out


def jaccard(equal: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Estimated similarity from the share of equal registers, less the share expected to agree by chance.

    The chance is HyperMinHash's approximation for MANTISSA bits and sets of sizes n and m.
    """
    ratio = np.maximum(n, m) / np.minimum(n, m)
    chance = 0.169919487159739 / (1 << MANTISSA) * 4 * ratio / (1 + ratio) ** 2
    return (equal - chance) / (1 - chance)


SKETCH = T.StructType(
    [
        T.StructField("n_shingles", T.LongType()),
        T.StructField("set_a", T.LongType()),
        T.StructField("set_b", T.LongType()),
        T.StructField("sketch", T.ArrayType(T.LongType())),
    ]
)


def sketches(size: int):
    """Texts to number of shingles, a 128-bit name of the set, and the sketch as one long per band."""

    def compute(texts: list[str | None]) -> list[pa.Array]:
        n = np.zeros(len(texts), np.int64)
        names = np.zeros((2, len(texts)), np.uint64)
        found: list[np.ndarray | None] = [None] * len(texts)
        for row, words in word_hashes(texts):
            hashes = np.unique(shingles(words, size))
            n[row] = len(hashes)
            names[0, row] = hashes.sum()
            names[1, row] = mix(hashes ^ np.uint64(0x5851F42D4C957F2D)).sum()
            found[row] = registers(hashes).view(np.int64)
        return [pa.array(n), *[pa.array(x.view(np.int64)) for x in names], pa.array(found, pa.list_(pa.int64()))]

    return compute


def links_of(left: pd.DataFrame, right: pd.DataFrame, percent: int) -> list[tuple[int, int]]:
    """Verified links between rows of two blocks (which may be one) that joins up what no link has joined yet.

    Rows have node, root, n, sketch, hashes. Sketches pick the pairs, full sets confirm them; of the links between
    two groups that are joined already by others, none is given.
    """
    parent = {r: r for r in {*left["root"], *right["root"]}}

    def top(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    marks = np.stack(right["sketch"].to_numpy()).view(np.uint16)
    sizes = right["n"].to_numpy()
    nodes, roots, sets = right["node"].to_numpy(), right["root"].to_numpy(), [np.asarray(x).view(np.uint64) for x in right["hashes"]]
    found = []
    for node, root, n, sketch, hashes in left[["node", "root", "n", "sketch", "hashes"]].itertuples(index=False):
        fits = (100 * np.minimum(sizes, n) >= percent * np.maximum(sizes, n)) & (nodes != node) & (roots != root)
        at = np.flatnonzero(fits)
        if not len(at):
            continue
        equal = (marks[at] == np.asarray(sketch).view(np.uint16)).mean(1)
        close = jaccard(equal, sizes[at], n) >= percent / 100 - MARGIN
        at = at[close | (np.minimum(sizes[at], n) < SMALL_SET) & (equal > 0)]
        here = top(root)
        at = [k for k in at if top(roots[k]) != here]
        if not at:
            continue
        other = np.concatenate([sets[k] for k in at])
        own = np.asarray(hashes).view(np.uint64)
        place = np.minimum(np.searchsorted(own, other), len(own) - 1)
        shared = np.add.reduceat((own[place] == other).astype(np.int64), np.concatenate([[0], np.cumsum(sizes[at])[:-1]]))
        for k, both in zip(at, shared):
            if 100 * both >= percent * (n + sizes[k] - both) and top(root) != top(roots[k]):
                parent[max(top(root), top(roots[k]))] = min(top(root), top(roots[k]))
                found.append((int(node), int(nodes[k])))
    return found


LINK = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])


def hub_links(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Verified links of the nodes of large clusters with their hubs.

    A node's hub is, of all members of its bands, the one whose bands have most members together.
    """
    inside = members.join(sets.select("node"), "node", "left_semi")
    met = inside.groupBy("node").agg(F.sum("n").alias("met"))
    best = stored(inside.join(met, "node").groupBy("band").agg(F.max(F.struct("met", (-F.col("node")).alias("low"))).alias("hub")), "near-dup-best")
    pairs = inside.join(best, "band").groupBy("node").agg((-F.max("hub")["low"]).alias("hub")).where("node <> hub")
    facing = sets.select("node", "n", "hashes").join(pairs, "node").join(
        sets.select(F.col("node").alias("hub"), F.col("n").alias("hub_n"), F.col("hashes").alias("hub_hashes")), "hub"
    )
    both = F.size(F.array_intersect("hashes", "hub_hashes"))
    near = 100 * both >= percent * (F.col("n") + F.col("hub_n") - both)
    return stored(facing.where(near).select(F.col("node").alias("a"), F.col("hub").alias("b")), "near-dup-hubs")


def large_blocks(sets: DataFrame, joined: DataFrame) -> DataFrame:
    """Pairs of blocks of the large clusters: nodes outside a cluster's largest group against all its nodes."""
    rooted = sets.join(joined, "node", "left").withColumn("root", F.coalesce("root", "node"))
    share = rooted.groupBy("cluster", "root").agg(F.count(F.lit(1)).alias("c"))
    # Tables of a row or a block per cluster are written, so that Spark knows their size and needn't gather a cluster.
    main = stored(share.groupBy("cluster").agg(F.max(F.struct("c", "root"))["root"].alias("main")), "near-dup-main")
    rooted = rooted.join(main, "cluster").withColumn("block", F.pmod(F.xxhash64("node"), F.ceil(F.col("size") / BLOCK)).cast("int"))
    outside = F.col("root") != F.col("main")
    with_outside = stored(rooted.where(outside).select("cluster", F.col("block").alias("i")).distinct(), "near-dup-outside")
    every = stored(rooted.select("cluster", F.col("block").alias("j")).distinct(), "near-dup-every")
    lefts = rooted.where(outside).withColumnRenamed("block", "i").join(every, "cluster").withColumn("side", F.lit(0))
    rights = rooted.withColumnRenamed("block", "j").join(with_outside, "cluster").withColumn("side", F.lit(1))
    return lefts.unionByName(rights).withColumn("key", F.col("cluster"))


def groups(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    percent: int = SIMILARITY_PERCENT,
) -> DataFrame:
    """The columns of ``docs`` with n_shingles, component_id and first, by exact similarity of shingle sets.

    Texts are linked when their sets of word shingles (A-Z lowered) share ``percent`` of their union. component_id is
    the smallest id that links reach, ``first`` marks one row of each component: that of the smallest id.

    1. One pass computes each text's sketch and the name of its set; the table is written with a number for each row.
    2. Rows of equal sets become one node. The bands of the nodes' sketches are counted; those that two or more hold link
       their nodes to the smallest, without verification. The components of these links, the clusters, hold
       every pair that may be similar.
    3. In a cluster of more than BLOCK nodes each node is verified against its hub, the member of its bands that meets
       most others. Copies of one text gather around the one that is nearest to all.
    4. The rest is compared in blocks of BLOCK nodes: small clusters whole, many to a task; large ones as blocks of
       the nodes outside the main group against blocks of all. A task gives no more links than join up its groups.
    5. Components of the verified links, and of equal sets, give the result.

    Null and empty texts have no shingles and are linked with nothing, each its own component; null ids come last,
    and a component of null ids only has a null id. Rows that repeat an id and text are one component, of
    which one row is ``first``. An empty table gives an empty result.
    """
    added = ["n_shingles", "component_id", "first"]
    found = grouped(docs, doc_id, text, shingle, percent)
    kept = [F.col("record")[c].alias(c) for c in without(docs, *added)]
    return found.select(*kept, *added)


def grouped(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, percent: int = SIMILARITY_PERCENT) -> DataFrame:
    """As ``groups``, with each whole row of ``docs`` as ``record``."""
    body = F.col("record")[text]
    source = docs.select(
        F.monotonically_increasing_id().alias("_row"),
        quoted(doc_id).cast("long").alias("_id"),
        F.struct(*[quoted(c) for c in docs.columns]).alias("record"),
        quoted(text).alias("_t"),
    )
    rows = stored(map_text(source, "_t", SKETCH, lambda: sketches(shingle)), "near-dup-rows")
    lowest = F.min(F.struct(F.col("_id").isNull().alias("none"), F.col("_id"), F.col("_row")))
    nodes = stored(
        rows.where("n_shingles > 0").groupBy("set_a", "set_b", "n_shingles")
        .agg(lowest.alias("low"), F.min("_row").alias("node"), F.first("sketch").alias("sketch")),
        "near-dup-nodes",
    )
    bands = nodes.select("node", F.posexplode("sketch")).select("node", F.xxhash64("pos", "col").alias("band"))
    # Written before it is joined, so that adaptive execution can split a band that many nodes have.
    shared = stored(bands.groupBy("band").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("centre")).where("n > 1"), "near-dup-bands")
    members = stored(bands.join(shared, "band"), "near-dup-members")
    clusters = components(members.where("node <> centre"), "node", "centre")
    # Sizes and owners are written too: a large cluster, or group, must not gather its nodes in one task.
    sizes = stored(clusters.groupBy("root").agg(F.count(F.lit(1)).alias("size")), "near-dup-sizes")
    clustered = clusters.join(sizes, "root").select("node", F.col("root").alias("cluster"), "size")
    # The sets of the nodes in clusters, from the whole texts.
    picked = nodes.drop("low").join(clustered, "node")
    texts = rows.select(F.col("_row").alias("node"), body.alias("_t")).join(picked.select("node", "cluster", "size", "n_shingles", "sketch"), "node")

    def full_sets() -> Iterator:
        def compute(batch: list[str | None]) -> list[pa.Array]:
            found: list = [None] * len(batch)
            for row, words in word_hashes(batch):
                found[row] = np.unique(shingles(words, shingle)).view(np.int64)
            return [pa.array(found, pa.list_(pa.int64()))]

        return compute

    hashes = T.StructType([T.StructField("hashes", T.ArrayType(T.LongType()))])
    sets = stored(map_text(texts, "_t", hashes, full_sets).withColumnRenamed("n_shingles", "n"), "near-dup-sets")
    large = F.col("size") > BLOCK

    body_columns = ["node", "root", "n", "sketch", "hashes"]
    packs = int(sets.where(~large).count() // BLOCK + 1)
    # Small clusters go whole into packs of about BLOCK nodes.
    parts = sets.where(~large).withColumn("root", F.col("node")).select(
        F.pmod(F.xxhash64("cluster"), F.lit(packs)).alias("key"), F.lit(-1).alias("i"), F.lit(-1).alias("j"), "cluster", F.lit(0).alias("side"), *body_columns
    )
    to_hub = None
    if not sets.where(large).isEmpty():
        to_hub = hub_links(members, sets.where(large), percent)
        parts = parts.unionByName(large_blocks(sets.where(large), components(to_hub)).select(parts.columns))

    def compare(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        found: list[tuple[int, int]] = []
        if key[1] < 0:
            for _, rows_of in part.groupby("cluster"):
                found += links_of(rows_of, rows_of, percent)
        else:
            found += links_of(part[part["side"] == 0], part[part["side"] == 1], percent)
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    by_blocks = parts.groupBy("key", "i", "j").applyInPandas(compare, LINK)
    labels = components(by_blocks if to_hub is None else by_blocks.unionByName(to_hub))

    ends = (
        nodes.select("set_a", "set_b", "n_shingles", "node", "low").join(labels, "node", "left")
        .withColumn("root", F.coalesce("root", "node"))
    )
    owners = stored(ends.groupBy("root").agg(F.min("low").alias("owner")), "near-dup-owners")
    named = ends.join(owners, "root").select("set_a", "set_b", "n_shingles", "owner")
    return rows.select("_row", "_id", *SKETCH.fieldNames()[:3], "record").join(named, ["set_a", "set_b", "n_shingles"], "left").select(
        "record",
        "n_shingles",
        F.when(F.col("owner").isNull(), F.col("_id")).otherwise(F.col("owner._id")).alias("component_id"),
        (F.col("owner").isNull() | (F.col("owner._row") == F.col("_row"))).alias("first"),
    )
