import random

import pytest
from pyspark.sql import functions as F

from wordsieve.functions.text import CONTROL_CHARS, PROFILES, clean_text, normalise_word, text_lines

MARKS = list("@?!/\\&% ？】”“'ab好\t\n\u0001 ") + ["//", "/@/", "/ /"]


def plain_clean(text, profile):
    for old, new in PROFILES[profile]:
        text = text.replace(old, new)
    return text.strip(CONTROL_CHARS)


@pytest.mark.parametrize("profile", sorted(PROFILES))
def test_profiles_equal_a_chain_of_replacements(spark, profile):
    rng = random.Random(7)
    texts = ["".join(rng.choice(MARKS) for _ in range(rng.randrange(25))) for _ in range(400)]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r.i: r.c for r in rows.select("i", clean_text(F.col("t"), profile).alias("c")).collect()}
    assert got == {i: plain_clean(t, profile) for i, t in enumerate(texts)}


@pytest.mark.parametrize(
    ("profile", "text", "expected"),
    [
        ("filter", "/@/x", "x"),
        ("filter", "/ /x", "//x"),
        ("filter", "///x", "/x"),
        ("filter", "\tab\n", "ab"),
        ("filter", "a b\\c&d", "abcd"),
        ("filter_cjk", "“好”？】", "'好'"),
        ("train", " a b% ", "a b"),
        ("stream", "50%", "50%"),
        ("ascii", "“a b”?", "“a b”"),
        ("filter", "", ""),
        ("filter", None, None),
    ],
)
def test_literal_cases(spark, profile, text, expected):
    row = spark.createDataFrame([(text,)], "t string").select(clean_text(F.col("t"), profile).alias("c")).first()
    assert row.c == expected


def test_lines_and_normalised_words(spark):
    row = spark.createDataFrame([("a\r\nb\rc\n\nd", " Ärger?! ")], "t string, w string").select(
        text_lines(F.col("t")).alias("lines"), normalise_word(F.col("w")).alias("word")
    ).first()
    assert row.lines == ["a", "b", "c", "", "d"]
    assert row.word == "ärger"
