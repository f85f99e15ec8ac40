"""Supervised subword embeddings: learned vectors of hashed words and n-grams, averaged, and a softmax."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wordsieve.llm.common import map_text, quoted
from wordsieve.llm.labelled import sample
from wordsieve.llm.ngrams import WHITE, Block, slots, text_blocks, windows, word_ids

THRESHOLD = 0.3
# Texts of each label that a model is fitted on.
PER_LABEL = 1500

BITS = 16
DIMENSIONS = 8
SIZES = (3, 4, 5)
# Steps of the descent, and the most passes over a small sample.
STEPS, EPOCHS = 18_000, 60
RATE = 0.3

# Marks a pair of equal words.
SAME = np.uint32(0x51ED270B)


def tokens(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Slots of a block and the place of each: words, character n-grams in their case, and the mark of equal words.

    A word that equals the one before has the mark once for each of its bytes, about as often as it has n-grams.
    """
    ids = word_ids(block)
    again = np.concatenate([[False], ids[1:] == ids[:-1]]) * (block.last - block.first) if len(ids) else np.zeros(0, np.int64)
    found = [slots(ids, BITS), np.full(again.sum(), slots(np.array([SAME]), BITS)[0])]
    places = [block.first, np.repeat(block.first, again)]
    for _, hashes in windows(block.data, SIZES):
        found.append(slots(hashes, BITS))
        places.append(np.arange(len(hashes)))
    return np.concatenate(found), np.concatenate(places)


class Model:
    """score(text) = softmax(output x mean of its tokens' vectors)."""

    def __init__(self, vectors: np.ndarray, output: np.ndarray, bias: np.ndarray):
        # The output is linear in the mean, so each slot's vector is folded into its part of the difference of logits.
        self.parts = (vectors @ (output[:, 1] - output[:, 0])).astype(np.float32)
        self.bias = float(bias[1] - bias[0])

    def score(self, texts: Sequence[str | None]) -> np.ndarray:
        """Probability of label 1 for each whole text; a text without words has that of the bias alone."""
        total, count = np.zeros(len(texts)), np.zeros(len(texts))
        for block in text_blocks(texts, WHITE, False):
            ids = word_ids(block)
            again = np.concatenate([[False], ids[1:] == ids[:-1]]) * (block.last - block.first) if len(ids) else np.zeros(0, np.int64)
            words = self.parts[slots(ids, BITS)] + again * self.parts[slots(np.array([SAME]), BITS)[0]]
            cuts = np.searchsorted(block.first, np.concatenate([block.begin[1:], [len(block.data)]]))
            sums = np.diff(np.concatenate([[0.0], np.cumsum(words, dtype=np.float64)])[np.concatenate([[0], cuts])])
            n = np.diff(np.concatenate([[0], np.cumsum(1 + again)])[np.concatenate([[0], cuts])]).astype(float)
            edges = np.concatenate([block.begin, [len(block.data)]])
            for size, hashes in windows(block.data, SIZES):
                # A window belongs to the piece in which it starts; those over the end of a piece count for none.
                running = np.concatenate([[0.0], np.cumsum(self.parts[slots(hashes, BITS)], dtype=np.float64)])
                last = np.maximum(edges[1:] - size + 1, edges[:-1])
                sums += running[last] - running[edges[:-1]]
                n += last - edges[:-1]
            np.add.at(total, block.rows, sums)
            np.add.at(count, block.rows, n)
        return 1 / (1 + np.exp(-np.clip(total / np.maximum(count, 1) + self.bias, -50, 50)))


def fit(texts: Sequence[str], labels: Sequence[int], rates: dict, seed: int = 5) -> Model:
    """Stochastic gradient descent with a step for each slot that shrinks with its gradients so far.

    Labels weigh by the inverse of the rate at which they were drawn, the mean weight being 1. With no
    texts the score is one half.
    """
    rng = np.random.default_rng(seed)
    vectors = rng.normal(0, 0.5, (1 << BITS, DIMENSIONS)).astype(np.float32)
    output = rng.normal(0, 0.5, (DIMENSIONS, 2))
    bias = np.zeros(2)
    if not len(texts):
        return Model(vectors * 0, output, bias)
    bags = []
    for text in texts:
        total = np.zeros(1 << BITS)
        for block in text_blocks([text], WHITE, False):
            found, places = tokens(block)
            total += np.bincount(found, minlength=1 << BITS)
        at = np.flatnonzero(total)
        bags.append((at.astype(np.int32), (total[at] / max(1, total.sum())).astype(np.float32)))
    weight = np.array([1 / rates.get(y, 1.0) for y in labels])
    weight /= weight.mean()
    seen, seen_output, seen_bias = np.full(1 << BITS, 1e-8, np.float32), np.full(output.shape, 1e-8), np.full(2, 1e-8)
    epochs = min(EPOCHS, -(-STEPS // len(bags)))
    for epoch in range(epochs):
        step = RATE * (1 - epoch / epochs)
        for k in rng.permutation(len(bags)):
            at, share = bags[k]
            hidden = share @ vectors[at]
            logits = hidden @ output + bias
            p = np.exp(logits - logits.max())
            wrong = weight[k] * (p / p.sum() - np.eye(2)[int(labels[k])])
            back = output @ wrong
            grad = np.outer(hidden, wrong)
            seen[at] += (share * share) * float(back @ back)
            vectors[at] -= (step * share / np.sqrt(seen[at]))[:, None] * back.astype(np.float32)
            seen_output += grad * grad
            output -= step * grad / np.sqrt(seen_output)
            seen_bias += wrong * wrong
            bias -= step * wrong / np.sqrt(seen_bias)
    return Model(vectors, output, bias)


def quality(docs: DataFrame, labels: DataFrame, text: str = "text", per_label: int = PER_LABEL, threshold: float = THRESHOLD) -> DataFrame:
    """The columns of ``docs`` but the text, with score and predicted for each whole text.

    The model is fitted on the driver to about ``per_label`` texts of each of the labels 0 and 1 given in ``labels`` (doc_id,
    label), other labels being left out; its table, of fixed size, is sent to the tasks, which score where the text is read. Null and empty
    texts get the score of no tokens. Repeated rows score alike; an empty table gives an empty result.
    """
    found, rates = sample(docs, labels.where(F.col("label").isin(0, 1)), per_label, text)
    model = docs.sparkSession.sparkContext.broadcast(fit(found["text"].tolist(), found["label"].astype(int).tolist(), rates))
    out = T.StructType([T.StructField("score", T.DoubleType())])
    scored = map_text(docs, text, out, lambda: lambda texts: [pa.array(model.value.score(texts))])
    return scored.withColumn("predicted", (quoted("score") >= threshold).cast("int"))
