"""Ranked search against a plain version."""

import math
import re
from collections import Counter

import pytest

from wordsieve.llm import ranked as R

PATTERN = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def plain_terms(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return PATTERN.findall(lowered)


def brute(docs, items, top=10):
    found = [(i, Counter(plain_terms(t))) for i, t in docs]
    found = [(i, c) for i, c in found if c]
    n, length = len(found), sum(c.total() for _, c in found)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(plain_terms(t))
    rows = []
    for item, terms in asked.items():
        scored = []
        for doc, c in found:
            m = 10 + 90 * c.total() * n // length
            score = 0
            for t in terms & c.keys():
                df = sum(t in o for _, o in found)
                score += math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
            if score > 0:
                scored.append((-score, doc is None, doc or 0))
        rows += [(item, k + 1, None if none else doc, -minus) for k, (minus, none, doc) in enumerate(sorted(scored)[:top])]
    return sorted(rows, key=str)


def got(spark, docs, items, **options):
    frame = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, score long").repartition(4)
    asked = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, rank int")
    return sorted((tuple(r) for r in R.search(frame, asked, **options).collect()), key=str)


def test_terms():
    text = "Don't STOP: naïve ÀÉ 3.14 日本語、x\x00y\x7fz Œ​a b"
    assert [t.decode() for t in R.terms(text)] == plain_terms(text)
    assert R.terms(None) == R.terms("") == R.terms("?! \n") == []


@pytest.fixture
def corpus(rng):
    words = [f"w{k}" for k in range(40)] + ["İx", "straße", "日本"]
    docs = [(i, " ".join(rng.choices(words, weights=range(len(words), 0, -1), k=rng.randint(0, 60)))) for i in range(300)]
    # Copies, repeated ids, null ids, nulls, empty and very long texts.
    docs += [(1000 + i, docs[5][1]) for i in range(60)] + [(7, docs[5][1]), (7, docs[5][1]), (None, docs[5][1]), (None, "w1 w2"), (900, None), (901, ""), (902, "w39 " * 60000)]
    items = [(i, " ".join(rng.choices(words, k=12)) + ".") for i in range(20)] + [(50, docs[5][1]), (51, None), (52, ""), (53, "absent"), (54, "w1"), (54, "W39 w1"), (None, "w3")]
    return docs, items


@pytest.mark.parametrize("top", [1, 10])
def test_search(spark, corpus, top):
    assert got(spark, *corpus, top=top) == brute(*corpus, top=top)


def test_blocks_of_items(spark, corpus):
    """Several blocks of items give the same rows as one."""
    assert got(spark, *corpus, index_bytes=8000) == brute(*corpus)


def test_small_steps(spark, corpus, monkeypatch):
    docs, items = corpus
    index = R.Index([(i, t) for i, x in items for t in sorted(set(R.terms(x)))])
    monkeypatch.setattr(R, "CELLS", 1)
    one = R.Heaps(index, 3)
    index.weigh({k: 5 for k in range(len(index.number))}, 300, 9000)
    for i, t in docs:
        one.add(i, t)
    monkeypatch.setattr(R, "CELLS", 1 << 30)
    other = R.Heaps(index, 3)
    for i, t in docs:
        other.add(i, t)
    assert sorted(map(str, one.rows())) == sorted(map(str, other.rows()))


def test_item_beyond_a_block(spark):
    with pytest.raises(ValueError):
        got(spark, [(1, "a")], [(1, " ".join(f"t{k}" for k in range(100)))], index_bytes=1000)


def test_empty(spark):
    assert got(spark, [], [(1, "a")]) == got(spark, [(1, "a")], []) == got(spark, [(1, None)], [(1, "a")]) == []
