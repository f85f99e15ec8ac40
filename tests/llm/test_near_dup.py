import re

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import edited, prose
from wordsieve.llm import near_dup
from wordsieve.llm.common import BLOCK_CHARS
from wordsieve.llm.words import word_hashes


def sets(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c < "\x80" else c for c in text or ""))
    if not words:
        return set()
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))}


def brute(rows, size=4, percent=80):
    """Component of each place in rows, by comparing all pairs."""
    found = [sets(t, size) for _, t, _ in rows]
    parent = list(range(len(rows)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(found[a] & found[b])
            if both and 100 * both >= percent * len(found[a] | found[b]):
                parent[max(top(a), top(b))] = min(top(a), top(b))
    members = {}
    for k, (i, _, _) in enumerate(rows):
        members.setdefault(top(k), []).append(i)
    return [(i, len(found[k]), min(members[top(k)], key=lambda x: (x is None, x))) for k, (i, _, _) in enumerate(rows)]


def family(rng, base, n, most):
    return [edited(rng, base, rng.randint(0, most)) for _ in range(n)]


def cases(rng):
    texts = [prose(rng, rng.randint(1, 60)) for _ in range(60)]
    for size, n, most in ((40, 40, 3), (150, 60, 9), (400, 15, 20), (12, 15, 1), (5, 6, 1)):
        texts += family(rng, prose(rng, size), n, most)
    texts += [texts[3]] * 30 + ["", None, " \n ", "one", "One", "ONE two three", "one two three"]
    rows = [(i, t, "s") for i, t in enumerate(rng.sample(texts, len(texts)))]
    return rows


@pytest.mark.parametrize("block", [8, 256])
def test_components_equal_brute_force(docs, rng, monkeypatch, block):
    monkeypatch.setattr(near_dup, "BLOCK", block)
    rows = cases(rng)
    got = near_dup.groups(docs(rows)).select("doc_id", "n_shingles", "component_id", "first").collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == sorted(brute(rows))
    assert all(r.first == (r.doc_id == r.component_id) for r in got)


def test_repeated_rows_null_ids_and_clashing_names(docs):
    rows = [(5, "a b c d e f", "s"), (5, "a b c d e f", "s"), (None, "a b c d e f", "s"), (None, "x y", "s"), (2, None, "s"), (2, "", "s")]
    df = docs(rows).withColumn("n_shingles", F.lit("old")).withColumn("node", F.lit(1)).withColumn("root", F.lit(2))
    got = near_dup.groups(df).collect()
    assert len(got) == 6 and sum(r.first for r in got) == 4
    assert {(r.doc_id, r.component_id) for r in got} == {(5, 5), (None, 5), (None, None), (2, 2)}
    assert {r.node for r in got} == {1} and {r.root for r in got} == {2}


def test_empty_table_and_long_text(docs, rng):
    assert near_dup.groups(docs([])).collect() == []
    long = " ".join(prose(rng, 2000) for _ in range(100))
    got = near_dup.groups(docs([(1, long, "s"), (2, long + " tail", "s"), (3, long[: len(long) // 2], "s")])).collect()
    assert {(r.doc_id, r.component_id) for r in got} == {(1, 1), (2, 1), (3, 3)}


def test_estimate_follows_the_similarity(rng):
    import numpy as np

    from wordsieve.llm.near_dup import jaccard, registers

    gen = np.random.default_rng(1)
    for share in (0.5, 0.8, 0.95):
        errors = []
        for _ in range(40):
            pool = gen.integers(0, 2**63, 2000, dtype=np.uint64) * np.uint64(2)
            common = int(2000 * share)
            half = (2000 - common) // 2
            a, b = np.unique(pool[: common + half]), np.unique(np.concatenate([pool[:common], pool[common + half :]]))
            equal = (registers(a) == registers(b)).mean()
            errors.append(jaccard(equal, np.float64(len(a)), np.float64(len(b))) - len(np.intersect1d(a, b)) / len(np.union1d(a, b)))
        assert abs(np.mean(errors)) < 0.02


@pytest.mark.parametrize("mark", ["\u00a0", "\u3000", "\u2028", "\u0085", "\x1c", "\x1f"])
def test_long_texts_are_cut_at_ascii_white_space_only(mark):
    word = f"left{mark}right"
    head = "abc " * ((BLOCK_CHARS - 4) // 4)
    text = f"{head}{word} end"
    assert text[BLOCK_CHARS] == mark
    (_, found), = word_hashes([text])
    assert len(found) == len(head) // 4 + 2
    (_, own), = word_hashes([word])
    assert found[-2] == own[0]
