"""Nearest-centroid language identification over TF-IDF vectors of hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wordsieve.llm.common import map_text, quoted
from wordsieve.llm.labelled import sample
from wordsieve.llm.ngrams import PLAIN, slots, text_blocks, windows

UNKNOWN = "und"
# Texts of each language that the centroids are fitted on, and centroids to a language.
PER_LANGUAGE = 1000
# Texts that they are fitted on at most, in all languages, and that are counted at a time: a text takes 16 KB of counts.
FIT_ROWS = 8192
BLOCK_ROWS = 512
CENTROIDS = 4
ROUNDS = 10

BITS = 12
SIZES = (1, 2, 3)
# A text is rejected when its cosine is below this share of that of the farthest hundredth of its centroid's texts.
REJECT = 0.5


def counts(texts: Sequence[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows and their n-gram counts, complete for each row that is given; rows without text are not."""
    carry_row, carry = -1, None
    for block in text_blocks(texts, PLAIN, True, BLOCK_ROWS):
        # Letters of any script stay; other ASCII counts as a blank.
        data = np.where(PLAIN[block.data], 32, block.data).astype(np.uint8)
        piece = block.piece_of(np.arange(len(data)))
        rows, at = np.unique(block.rows, return_inverse=True)
        total = np.zeros(len(rows) << BITS, np.float32)
        for size, hashes in windows(data, SIZES):
            where = (at[piece[: len(hashes)]] << BITS) + slots(hashes, BITS)
            total += np.bincount(where, minlength=len(total))
            # Windows over the end of a piece count for none.
            over = (block.begin[1:, None] - np.arange(1, size)).ravel()
            total -= np.bincount(where[over[over < len(where)]], minlength=len(total))
        total = total.reshape(len(rows), -1)
        if carry_row == rows[0]:
            total[0] += carry
        elif carry is not None:
            yield np.array([carry_row]), carry[None]
        # The last text of a block may go on in the next.
        carry_row, carry = rows[-1], total[-1].copy()
        if len(rows) > 1:
            yield rows[:-1], total[:-1]
    if carry is not None:
        yield np.array([carry_row]), carry[None]


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.sqrt((x * x).sum(1, keepdims=True)), 1e-12)


class Model:
    def __init__(self, idf: np.ndarray, centroids: np.ndarray, names: list[str], floors: np.ndarray):
        self.idf, self.centroids, self.names, self.floors = idf, centroids, names, floors

    def vectors(self, found: np.ndarray) -> np.ndarray:
        return unit(np.log1p(found) * self.idf)

    def predict(self, texts: Sequence[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """The language of the nearest centroid, the cosine with it, and whether it is too far."""
        names = [UNKNOWN] * len(texts)
        score, far = np.zeros(len(texts)), np.ones(len(texts), bool)
        if self.names:
            for rows, found in counts(texts):
                cosine = self.vectors(found) @ self.centroids.T
                best = cosine.argmax(1)
                score[rows] = np.clip(cosine[np.arange(len(rows)), best], 0, 1)
                far[rows] = score[rows] < self.floors[best]
                for row, k in zip(rows, best):
                    names[row] = self.names[k]
        return names, score, far


def fit(texts: Sequence[str], labels: Sequence[str], seed: int = 5) -> Model:
    """Spherical k-means in each language; ``floors`` holds the least cosine that each centroid accepts."""
    dense = np.zeros((len(texts), 1 << BITS), np.float32)
    for rows, found in counts(texts):
        dense[rows] = found
    idf = (np.log((1 + len(texts)) / (1 + (dense > 0).sum(0))) + 1).astype(np.float32)
    x = np.log1p(dense, out=dense)
    x *= idf
    # By blocks, so that no second table is held.
    for k in range(0, len(x), BLOCK_ROWS):
        x[k : k + BLOCK_ROWS] = unit(x[k : k + BLOCK_ROWS])
    rng = np.random.default_rng(seed)
    centroids, names, floors = [], [], []
    for name in sorted(set(labels)):
        own = x[[k for k, y in enumerate(labels) if y == name]]
        middle = own[rng.choice(len(own), min(CENTROIDS, len(own)), replace=False)]
        for _ in range(ROUNDS):
            nearest = (own @ middle.T).argmax(1)
            middle = unit(np.stack([own[nearest == k].mean(0) if (nearest == k).any() else middle[k] for k in range(len(middle))]))
        cosine = own @ middle.T
        nearest = cosine.argmax(1)
        for k in range(len(middle)):
            if (nearest == k).any():
                centroids.append(middle[k])
                names.append(name)
                floors.append(REJECT * np.quantile(cosine[nearest == k, k], 0.01))
    return Model(idf, np.array(centroids, np.float32).reshape(-1, 1 << BITS), names, np.array(floors))


def languages(docs: DataFrame, labels: DataFrame, text: str = "text", per_language: int = PER_LANGUAGE, reject: bool = True) -> DataFrame:
    """The columns of ``docs`` but the text, with lang_pred, score and rejected for each whole text.

    Centroids are fitted on the driver to about ``per_language`` texts of each language in ``labels`` (doc_id, label), fewer
    where there are so many languages that these were more than FIT_ROWS, and sent to the tasks. Texts that lie too far from their nearest centroid are rejected: their language is
    unknown with ``reject``, and else they are only marked. Null texts and those without a letter are unknown, with
    score 0 and rejected. Repeated rows are judged alike; an empty table gives an empty result.
    """
    found, _ = sample(docs, labels, per_language, text, most_rows=FIT_ROWS)
    model = docs.sparkSession.sparkContext.broadcast(fit(found["text"].tolist(), found["label"].tolist()))
    out = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType())])

    def make():
        def compute(texts: list[str | None]) -> list[pa.Array]:
            names, score, far = model.value.predict(texts)
            return [pa.array(names, pa.string()), pa.array(score), pa.array(far)]

        return compute

    letters = F.coalesce(quoted(text).rlike(r"\p{L}"), F.lit(False))
    # A text without a letter goes in as null.
    judged = map_text(docs.withColumn("_letters", F.when(letters, quoted(text))), "_letters", out, make).drop(text)
    return judged.withColumn("lang_pred", F.when(F.col("rejected"), F.lit(UNKNOWN)).otherwise(F.col("lang_pred"))) if reject else judged
