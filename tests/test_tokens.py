import random
import re

import pytest
from pyspark.sql import functions as F

from wordsieve.functions import tokens as T
from wordsieve.operators import segment

LATIN = re.compile("[0-9a-zà-öø-ÿ]+")


def texts_of(rng, alphabet, n, longest):
    return ["".join(rng.choice(alphabet) for _ in range(rng.randrange(longest))) for _ in range(n)]


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "i int, t string")


def every_match(text, words):
    return sorted((at, w) for at in range(len(text)) for w in words if text.startswith(w, at))


def greedy(text, words):
    out, at = [], 0
    while at < len(text):
        here = [w for w in words if text.startswith(w, at)]
        term = max(here, key=len) if here else text[at]
        out.append((at, term, bool(here)))
        at += len(term)
    return out


def test_words_minlen_ngrams(spark):
    rows = frame(spark, ["Ça va, a É1!", "", "a", "a b c", None])
    got = {
        r.i: r
        for r in rows.select(
            "i", T.words(F.col("t")).alias("w"), T.longer_than(T.words(F.col("t"))).alias("l"),
            T.context_ngrams(T.words(F.col("t"))).alias("g"), T.blank_words(F.col("t")).alias("b"),
        ).collect()
    }
    assert got[0].w == ["ça", "va", "a", "é1"] and got[0].l == ["ça", "va", "é1"]
    assert got[1].g == [] and got[2].g == ["a"]
    assert got[3].g == ["a", "b", "ab", "abc", "c", "bc"]
    assert got[4].w is None and got[4].g is None
    assert got[0].b == ["ça", "va,", "a", "é1!"]


def test_spans_equal_a_scan(spark):
    rng = random.Random(3)
    texts = texts_of(rng, list("ab1É好 .\n😀") + ["long"], 60, 50) + ["x" * 3000 + " " + "好" * 2500 + " yz😀z"]
    texts.append(" ".join(texts_of(rng, list("abc é😀"), 400, 20)))
    spans = segment.word_spans(frame(spark, texts), ["i"], F.col("t")).collect()
    got = sorted((r.i, r.start, r.end, r.term) for r in spans)
    want = sorted((i, m.start(), m.end(), m.group()) for i, t in enumerate(texts) for m in LATIN.finditer(t.lower()))
    assert got == want


FRUIT = ["红苹果", "苹果", "苹果树"]


@pytest.mark.parametrize("size", ["inline", "compiled", "split", "shuffled"])
def test_literal_segmentation(spark, size, request):
    if size != "inline":
        request.getfixturevalue(size)
    rows, words = frame(spark, ["红苹果树", "", None, "abc"]), spark.createDataFrame([(w,) for w in FRUIT], "word string")
    found = segment.find_all(rows, ["i"], F.col("t"), words).collect()
    assert sorted(r.word for r in found) == sorted(FRUIT)
    tokens = segment.segment_greedy(rows, ["i"], F.col("t"), words).orderBy("i", "start").collect()
    assert [(r.i, r.term, r.known) for r in tokens] == [(0, "红苹果", True), (0, "树", False), (3, "abc", False)]


@pytest.mark.parametrize("mode", ["compiled", "split", "broadcast", "shuffled"])
def test_find_all_equals_brute_force(spark, mode, request):
    if mode != "inline":
        request.getfixturevalue(mode)
    rng = random.Random(5)
    words = sorted({w for w in texts_of(rng, "ab好😀", 40, 7) if w} | {"ab" * 40, "a", "好好好好好好好好好好好"})
    texts = texts_of(rng, "ab好😀 ", 40, 40) + ["ab" * 700 + "好" * 300, "", "a"]
    rows = frame(spark, texts)
    dictionary = spark.createDataFrame([(w,) for w in words] + [("",)], "word string")
    got = sorted((r.i, r.start, r.word) for r in segment.find_all(rows, ["i"], F.col("t"), dictionary).collect())
    assert got == sorted((i, at, w) for i, t in enumerate(texts) for at, w in every_match(t, words))


@pytest.mark.parametrize("longest", [6, 90])
def test_context_around_matches(spark, longest):
    words = ["ab", "好", "b" * longest]
    texts = ["ab", "xab好", "b" * 300, "好" + "a" * 255 + "b好"]
    dictionary = spark.createDataFrame([(w,) for w in words], "word string")
    rows = segment.find_all(frame(spark, texts), ["i"], F.col("t"), dictionary, context=2).collect()
    got = sorted((r.i, r.start, r.word, r.context) for r in rows)
    want = []
    for i, t in enumerate(texts):
        padded = "\0\0" + t
        want += [(i, at, w, padded[at : at + len(w) + 4]) for at, w in every_match(t, words)]
    assert got == sorted(want)


@pytest.mark.parametrize("size", ["inline", "compiled", "split", "shuffled"])
@pytest.mark.parametrize("latin_runs", [True, False])
def test_greedy_equals_brute_force(spark, latin_runs, size, request):
    if size != "inline":
        request.getfixturevalue(size)
    rng = random.Random(9)
    alphabet = "ab好树果" if latin_runs else "abc好"
    words = sorted({w for w in texts_of(rng, alphabet, 40, 5) if len(w) > 1})
    texts = texts_of(rng, list(alphabet) + [" ", "，"], 60, 40) + ["abc" * 900, "好树" * 700 + "a", ""]
    dictionary = spark.createDataFrame([(w,) for w in words], "word string")
    tokens = segment.segment_greedy(frame(spark, texts), ["i"], F.col("t"), dictionary, latin_runs).collect()
    got = sorted((r.i, r.start, r.end, r.term, r.known) for r in tokens)
    pattern = re.compile(f"{LATIN.pattern}|[^\\W0-9a-zà-öø-ÿ]+" if latin_runs else "\\w+")
    want = []
    for i, t in enumerate(texts):
        for run in pattern.finditer(t):
            if latin_runs and LATIN.fullmatch(run.group()):
                parts = [(0, run.group(), run.group() in words)]
            else:
                parts = greedy(run.group(), words)
            want += [(i, run.start() + at, run.start() + at + len(w), w, known) for at, w, known in parts]
    assert got == sorted(want)


def test_empty_dictionary(spark):
    none = spark.createDataFrame([], "word string")
    assert segment.find_all(frame(spark, ["abc"]), ["i"], F.col("t"), none).count() == 0
    assert segment.segment_greedy(frame(spark, ["好a"]), ["i"], F.col("t"), none).count() == 2
