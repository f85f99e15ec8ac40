"""A toxicity classifier whose score may not hang on which group a sentence names."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wordsieve.llm.common import map_text, quoted
from wordsieve.llm.labelled import sample
from wordsieve.llm.ngrams import PLAIN, Block, slots, text_blocks, windows, word_ids

THRESHOLD = 0.3
# Texts of each label that a model is fitted on.
PER_LABEL = 2000

BITS = 18
# Pairs of words have slots of their own behind those, so that the many pairs blur no word.
PAIR_BITS = 19
SLOTS = (1 << BITS) + (1 << PAIR_BITS)
SIZES = (3, 4, 5, 6)
EPOCHS = 6
RATE = 0.1
DECAY = 1e-4
# Texts of each label that are added to the counts of a pair of words, of which most are rare.
RARE = 10
# Odd number that tells the order of the words of a pair.
PAIR = np.uint32(0x2545F491)
# Weight of the squared change of the logit when an identity term is swapped.
FAIRNESS = 0.5

# Terms that name groups, by language, any of which may stand for another of its language in a sentence; a parameter of the fit.
IDENTITY_TERMS = (
    ("women", "men", "muslim", "muslims", "christian", "christians", "jewish", "jews", "hindu", "buddhist", "atheist", "gay", "lesbian",
     "straight", "transgender", "black", "white", "asian", "african", "mexican", "american", "european", "immigrant", "immigrants",
     "refugee", "refugees", "disabled", "blind", "deaf", "old", "young"),
    ("frauen", "männer", "muslime", "muslimisch", "christen", "christlich", "juden", "jüdisch", "hindus", "buddhisten", "atheisten",
     "schwule", "lesben", "schwul", "lesbisch", "schwarze", "weiße", "asiaten", "afrikaner", "türken", "polen", "ausländer",
     "einwanderer", "flüchtlinge", "behinderte", "blinde", "gehörlose", "alte", "junge"),
    ("femmes", "hommes", "musulmans", "musulman", "chrétiens", "chrétien", "juifs", "juif", "hindous", "bouddhistes", "athées", "gays",
     "lesbiennes", "noirs", "blancs", "asiatiques", "africains", "arabes", "américains", "européens", "immigrés", "réfugiés",
     "handicapés", "aveugles", "sourds", "vieux", "jeunes"),
    ("mujeres", "hombres", "musulmanes", "musulmán", "cristianos", "cristiano", "judíos", "judío", "hindúes", "budistas", "ateos",
     "gais", "lesbianas", "negros", "blancos", "asiáticos", "africanos", "mexicanos", "americanos", "europeos", "inmigrantes",
     "refugiados", "discapacitados", "ciegos", "sordos", "viejos", "jóvenes"),
)


def spans(block: Block) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray, np.ndarray]]]:
    """Bytes with marks as blanks, and for each size the slots of windows and each word's first and last+1 window."""
    data = np.where(PLAIN[block.data], 32, block.data).astype(np.uint8)
    found = []
    for n, hashes in windows(data, SIZES):
        # Windows inside the word with the blank on either side.
        begin = np.minimum(block.first - 1, len(hashes))
        found.append((slots(hashes, BITS), begin, np.maximum(begin, block.last + 2 - n)))
    return data, found


def pair_slots(block: Block, ids: np.ndarray) -> np.ndarray:
    """The slot of each word with the one before it in its piece, or with the beginning of the piece."""
    piece = block.piece_of(block.first)
    before = np.ones(len(ids), np.uint32)
    follows = np.flatnonzero(piece[1:] == piece[:-1]) + 1
    before[follows] = ids[follows - 1]
    return slots(before * PAIR + ids, PAIR_BITS) + np.uint32(1 << BITS)


def word_scores(block: Block, weights: np.ndarray) -> np.ndarray:
    """The sum of the weights of each word, of the n-grams in it, and of its pair with the word before."""
    ids = word_ids(block)
    total = weights[slots(ids, BITS)].astype(np.float64) + weights[pair_slots(block, ids)]
    for at, begin, end in spans(block)[1]:
        running = np.concatenate([[0.0], np.cumsum(weights[at], dtype=np.float64)])
        total += running[end] - running[begin]
    return total


class Model:
    """The logit of a text is that of its most toxic word: one insult in a long text counts as in a short one."""

    def __init__(self, weights: np.ndarray, slope: float, bias: float):
        self.weights, self.slope, self.bias = weights.astype(np.float32), slope, bias

    def peaks(self, texts: Sequence[str | None]) -> np.ndarray:
        """The highest score of a word in each text, 0 at least."""
        most = np.zeros(len(texts))
        for block in text_blocks(texts, PLAIN, True):
            if len(block.first):
                np.maximum.at(most, block.rows[block.piece_of(block.first)], word_scores(block, self.weights))
        return most

    def score(self, texts: Sequence[str | None]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.peaks(texts) + self.bias, -50, 50)))


def bag(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The slots of the words of a text one after the other, where each word's begin, and the words' hashes. Words that are
    equal and follow equal ones come once."""
    owners, found, names, before = [], [], [], 0
    for block in text_blocks([text], PLAIN, True):
        own = word_ids(block)
        if not len(own):
            continue
        pairs = pair_slots(block, own)
        _, keep = np.unique(np.stack([own, pairs]), axis=1, return_index=True)
        owners += [before + np.arange(len(keep))] * 2
        found += [slots(own, BITS)[keep], pairs[keep]]
        names.append(own[keep])
        for at, begin, end in spans(block)[1]:
            size = (end - begin)[keep]
            place = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            owners.append(before + np.repeat(np.arange(len(keep)), size))
            found.append(at[place + np.repeat(begin[keep], size)])
        before += len(keep)
    if not before:
        return np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.uint32)
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return np.concatenate(found)[order].astype(np.int32), np.searchsorted(owner[order], np.arange(before)), np.concatenate(names)


def peak(weights: np.ndarray, words: tuple) -> tuple[float, np.ndarray]:
    """The highest score of a word and that word's slots."""
    at, begin, _ = words
    if not len(begin):
        return 0.0, at
    sums = np.add.reduceat(weights[at], begin)
    k = int(sums.argmax())
    return float(sums[k]), at[begin[k] : begin[k + 1] if k + 1 < len(begin) else None]


def fit(texts: Sequence[str], labels: Sequence[int], rates: dict, terms: Sequence[Sequence[str]] = IDENTITY_TERMS, fairness: float = FAIRNESS, seed: int = 5) -> Model:
    """Stochastic gradient descent on the logistic loss of each text's highest word, from smoothed log odds.

    In each step a counterfactual of the text is made: a term that it holds is swapped for another of its language, or where it
    holds none, a term stands in place of one word. ``terms`` has a list for each language. The change of the logit,
    squared, is penalised. Terms are found among the words of a text, as scoring parses them. At the end slope and bias are fitted with each label at its weight in the table. Without texts of both labels nothing can be
    told apart, and all texts have one low score.
    """
    rng = np.random.default_rng(seed)
    weights = np.zeros(SLOTS, np.float64)
    y = np.asarray(labels, float)
    if not len(y) or y.min() == y.max():
        return Model(weights, 1.0, -4.0)
    bags = [bag(t) for t in texts]
    held = np.zeros((2, SLOTS))
    for (at, _, _), label in zip(bags, labels):
        held[int(label), np.unique(at)] += 1
    n = np.array([(y == 0).sum(), (y == 1).sum()])
    odds = np.log((held[1] + 1) / (n[1] + 2)) - np.log((held[0] + 1) / (n[0] + 2))
    # A word has some twenty slots that say much the same.
    weights = np.where(held.sum(0) > 0, np.clip(odds, -3, 3), 0) / 8
    # A pair has one slot; what it says needs many texts, and then weighs as much as a word's slots together.
    pairs = held[:, 1 << BITS :]
    weights[1 << BITS :] = np.clip(np.log((pairs[1] + RARE) / (n[1] + 2 * RARE)) - np.log((pairs[0] + RARE) / (n[0] + 2 * RARE)), -3, 3)
    named = [[bag(t) for t in own] for own in terms if own]
    language_of = {int(t[2][0]): k for k, own in enumerate(named) for t in own if len(t[2])}
    known = np.array(sorted(language_of), np.uint32)
    with_terms = [known[np.isin(known, words)] for _, _, words in bags]
    bias = -2.0
    for epoch in range(EPOCHS):
        step = RATE * (1 - epoch / EPOCHS)
        for k in rng.permutation(len(bags)):
            most, own = peak(weights, bags[k])
            wrong = 1 / (1 + np.exp(-np.clip(most + bias, -50, 50))) - y[k]
            weights[own] -= step * (wrong + DECAY * weights[own])
            bias -= step * wrong
            if not named:
                continue
            most, own = peak(weights, bags[k])
            present = with_terms[k]
            gone = present[int(rng.integers(len(present)))] if len(present) else None
            own_terms = named[int(rng.integers(len(named))) if gone is None else language_of[int(gone)]]
            other, changed = swapped(weights, bags[k], gone, own_terms, rng)
            # The gradient of fairness * (change)^2 / 2 at the two highest words.
            change = np.clip(fairness * (other - most), -2, 2)
            weights[changed] -= step * change
            weights[own] += step * change
    model = Model(weights, 1.0, bias)
    share = np.array([1 / rates.get(label, 1.0) for label in labels])
    model.slope, model.bias = calibrated(model.peaks(texts), y, share / share.mean())
    return model


def swapped(weights: np.ndarray, words: tuple, gone: int | None, named: list[tuple], rng: np.random.Generator) -> tuple[float, np.ndarray]:
    """The highest word of a counterfactual: the term ``gone``, or one word, replaced by a drawn term."""
    at, begin, names = words
    put = peak(weights, named[int(rng.integers(len(named)))])
    if not len(begin):
        return put
    ends = np.concatenate([begin[1:], [len(at)]])
    sums = np.add.reduceat(weights[at], begin)
    if gone is not None:
        sums[names == gone] = -np.inf
    else:
        # A word other than the one the text is judged by.
        k = int(rng.integers(len(begin)))
        if k != int(sums.argmax()):
            sums[k] = -np.inf
    k = int(sums.argmax())
    return put if put[0] >= sums[k] else (float(sums[k]), at[begin[k] : ends[k]])


def calibrated(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and bias of a weighted logistic regression on one number, by Newton's steps with a small penalty."""
    scale = max(float(np.abs(x).max()), 1e-6)
    a = np.stack([x / scale, np.ones_like(x)], 1)
    beta = np.zeros(2)
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(a @ beta, -50, 50)))
        grad = a.T @ (weight * (p - y)) + 0.02 * beta
        curve = (a * (weight * p * (1 - p))[:, None]).T @ a + 0.02 * np.eye(2)
        beta -= np.clip(np.linalg.solve(curve, grad), -5, 5)
    return max(float(beta[0]), 0.0) / scale, float(beta[1])


def toxicity(
    docs: DataFrame,
    labels: DataFrame,
    text: str = "text",
    per_label: int = PER_LABEL,
    threshold: float = THRESHOLD,
    terms: Sequence[Sequence[str]] = IDENTITY_TERMS,
    keep_text: bool = False,
) -> DataFrame:
    """The columns of ``docs`` with score and predicted for each whole text.

    The model is fitted on the driver to about ``per_label`` texts of each of the labels 0 and 1 in ``labels`` (doc_id, label),
    other labels being left out; its table, of fixed size, is sent to the tasks, which score where the text is read. Null and empty texts have no
    word and the lowest score. Repeated rows score alike; an empty table gives an empty result.
    """
    found, rates = sample(docs, labels.where(F.col("label").isin(0, 1)), per_label, text)
    fitted = fit(found["text"].tolist(), found["label"].astype(int).tolist(), rates, terms)
    model = docs.sparkSession.sparkContext.broadcast(fitted)
    out = T.StructType([T.StructField("score", T.DoubleType())])
    scored = map_text(docs, text, out, lambda: lambda texts: [pa.array(model.value.score(texts))], keep_text)
    return scored.withColumn("predicted", (quoted("score") >= threshold).cast("int"))
