"""Spelling variants against all pairs, and the words that texts give."""

import re
import zlib
from collections import Counter

import pytest

from wordsieve.llm import variants as V


def one_edit(a, b):
    """Whether two words differ by one inserted, deleted or replaced code point."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def brute(counts, ratio=2):
    found = {}
    for w, n in counts.items():
        near = [v for v in counts if one_edit(w, v)]
        best = min(near, key=lambda v: (-counts[v], v), default=None)
        form = best if best is not None and counts[best] >= ratio * n else None
        found[w] = (n, form, len(near), None if form is None else counts[form])
    roots = {}
    for w in found:
        at = w
        while found[at][1] is not None:
            at = found[at][1]
        roots[w] = at
    return {(w, n, form, roots[w], k, m) for w, (n, form, k, m) in found.items()}


def got(spark, counts, **options):
    words = spark.createDataFrame([(w, n, "x") for w, n in counts.items()], "word string, n int, form string")
    rows = V.variants(words, **options).select("word", "n", "form", "root", "n_near", "form_n").collect()
    assert len(rows) == len(counts)
    return {tuple(r) for r in rows}


@pytest.mark.parametrize("key_pairs", [1, 4, V.KEY_PAIRS])
def test_all_pairs(spark, rng, key_pairs):
    """A small alphabet makes dense neighbourhoods; with few pairs to a key all of them are chunked again and again."""
    counts = {}
    while len(counts) < 300:
        word = "".join(rng.choice("abé") for _ in range(rng.choice([2, 3, 5, 6, 7, 12])))
        counts[word] = rng.choice([1, 2, 3, 5, 9, 9, 40])
    counts |= {"z" * 60: 4, "z" * 61: 9, "z" * 62: 20, "y" + "z" * 59: 1}
    assert got(spark, counts, key_pairs=key_pairs) == brute(counts)


def test_ties_and_chains(spark):
    counts = {"color": 10, "colour": 20, "colours": 40, "dolor": 20, "valor": 20, "alone": 1}
    rows = {r[0]: r for r in got(spark, counts)}
    # Of two forms as frequent the first by code point, then on to the last.
    assert rows["color"] == ("color", 10, "colour", "colours", 2, 20)
    assert rows["colours"] == ("colours", 40, None, "colours", 1, None)
    assert rows["alone"] == ("alone", 1, None, "alone", 0, None)
    assert rows["dolor"][2] is None


def test_common_prefix_is_split(spark):
    """Words that share their first half are not compared as one group, and none of their links is lost."""
    counts = {"prefix" + a + b + c + "tail": 1 + (a == b) for a in "abcdefgh" for b in "abcdefgh" for c in "abcdefgh"}
    assert got(spark, counts, key_pairs=64) == brute(counts)


def test_damaged_words(spark, docs):
    texts = [(1, "Straße straße ÄRGER ärger don't 3D œuvre", "a"), (2, None, "a"), (3, "", "a"), (None, "hello hello", "b"), (1, "Straße", "b")]
    texts += [(i, "Recommend the colours of summer", "c") for i in range(10, 400)]
    want = Counter()
    for i, t, _ in texts:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            want[w[: h % len(w)] + w[h % len(w) + 1 :] if h % 97 == 0 else w] += 1
    assert {(r.word, r.n) for r in V.damaged_words(docs(texts)).collect()} == set(want.items())
    assert any(w not in " ".join(t or "" for _, t, _ in texts).lower() for w in want)


def test_empty(spark, docs):
    assert V.variants(V.damaged_words(docs([]))).collect() == []
    nulls = spark.createDataFrame([(None, 3), ("words", 5)], "word string, n long")
    assert [tuple(r) for r in V.variants(nulls).select("word", "root", "n_near").collect()] == [("words", "words", 0)]
