import random

import pytest
from pyspark.sql import functions as F

from wordsieve.fixtures import insult_lexicon
from wordsieve.operators import match

TEXTS = ["You CLOWN!", "a clownish act", "", None, "scum, idiot scum", "tr@ash", "i d i o t", "good"]


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "i int, t string")


def words(spark, *entries):
    return spark.createDataFrame([(w, "c") for w in entries], "word string, category string").withColumn(
        "word_id", F.md5("word")
    )


@pytest.mark.parametrize("size", ["inline", "compiled", "split", "shuffled"])
@pytest.mark.parametrize(
    ("profile", "mode", "sensitive"),
    [("train", "words", {0, 4, 5}), ("filter", "anywhere", {0, 1, 4, 5, 6}), (None, "words", {0, 4})],
)
def test_flag(spark, rows, size, profile, mode, sensitive, request):
    if size != "inline":
        request.getfixturevalue(size)
    flagged = match.flag_messages(rows, F.col("t"), insult_lexicon(spark), profile, mode)
    got = {r.i: r.is_sensitive for r in flagged.collect()}
    assert got == {i: None if t is None else i in sensitive for i, t in enumerate(TEXTS)}


def test_flag_many_words_anywhere(spark, rows):
    """More words than are sought one by one, of several lengths."""
    many = words(spark, "clownis", *[f"q{i}" for i in range(100)], "好")
    flagged = match.flag_messages(rows, F.col("t"), many, None, "anywhere")
    assert {r.i for r in flagged.where("is_sensitive").collect()} == {1}
    far = spark.createDataFrame([(0, "x" * 1020 + "clownish"), (1, "x" * 5000)], "i int, t string")
    assert {r.i for r in match.flag_messages(far, F.col("t"), many, None, "anywhere").where("is_sensitive").collect()} == {0}


def test_empty_lexicon(spark, rows):
    for mode in ("words", "anywhere"):
        flagged = match.flag_messages(rows, F.col("t"), words(spark), None, mode)
        assert {r.is_sensitive for r in flagged.where("t is not null").collect()} == {False}


def test_words_with_quotes_are_safe(spark):
    rows = spark.createDataFrame([(0, "it's \\ 'x'")], "i int, t string")
    flagged = match.flag_messages(rows, F.col("t"), words(spark, "'x'", "\\"), None, "anywhere")
    assert flagged.first().is_sensitive


@pytest.mark.parametrize("size", ["compiled", "split", "broadcast", "shuffled"])
def test_hits_first_and_counts(spark, rows, size, request):
    if size != "inline":
        request.getfixturevalue(size)
    hits = match.word_hits(rows, ["i"], F.col("t"), insult_lexicon(spark))
    assert sorted((r.i, r.pos, r.word) for r in hits.collect()) == [
        (0, 1, "clown"), (4, 0, "scum"), (4, 1, "idiot"), (4, 2, "scum"), (5, 0, "trash")
    ]
    first = match.first_match(rows, ["i"], F.col("t"), insult_lexicon(spark)).collect()
    assert sorted((r.i, r.pos, r.word) for r in first) == [(0, 1, "clown"), (4, 0, "scum"), (5, 0, "trash")]
    counts = {(r.i, r.word): r.n for r in match.match_counts(hits, ["i"]).collect()}
    assert counts == {(0, "clown"): 1, (4, "scum"): 2, (4, "idiot"): 1, (5, "trash"): 1}
    assert [tuple(r) for r in match.category_counts(hits, ["i"]).collect()] == [("insult", 5, 3)]


def test_phrase_hits_respect_word_edges(spark):
    texts = ["the end, the endless the end", "weekend the  end", "红苹果x", "x红苹果"]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    hits = match.phrase_hits(rows, ["i"], F.col("t"), words(spark, "the end", "end", "红苹果", "果x"), None)
    assert sorted((r.i, r.start, r.end, r.word) for r in hits.collect()) == [
        (0, 0, 7, "the end"), (0, 4, 7, "end"), (0, 21, 28, "the end"), (0, 25, 28, "end"),
        (1, 13, 16, "end"), (2, 0, 3, "红苹果"), (2, 2, 4, "果x"), (3, 1, 4, "红苹果"),
    ]


@pytest.mark.parametrize("size", ["compiled", "split", "broadcast", "shuffled"])
def test_widening_order(spark, size, request):
    if size != "inline":
        request.getfixturevalue(size)
    texts = ["红苹果树上", "苹果", "吃苹果", "大红苹果甜", "苹果树上", "无", "吃苹果树"]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    lexicon = words(spark, "苹果", "苹果树", "红苹果树", "红苹果树上", "吃苹果", "苹果树上", "红苹果甜")
    got = match.widened_match(rows, ["i"], F.col("t"), lexicon, words(spark, "苹果"))
    # At the end of the text the first attempt is cut back to the hit itself, which ends the search.
    assert sorted((r.i, r.word, r.widened) for r in got.collect()) == [
        (0, "苹果", "苹果树"), (1, "苹果", "苹果"), (2, "苹果", "苹果"), (3, "苹果", "红苹果甜"),
        (4, "苹果", "苹果树"), (6, "苹果", "苹果树"),
    ]


@pytest.mark.parametrize("size", ["inline", "compiled", "split", "shuffled"])
def test_segmented_verdict_lets_a_longer_word_cover(spark, size, request):
    if size != "inline":
        request.getfixturevalue(size)
    rows = spark.createDataFrame([(0, "红苹果"), (1, "苹果"), (2, None), (3, "好")], "i int, t string")
    got = match.flag_segmented(rows, ["i"], F.col("t"), words(spark, "苹果"), words(spark, "红苹果"))
    assert {r.i: r.is_sensitive for r in got.collect()} == {0: False, 1: True, 2: None, 3: False}


@pytest.mark.parametrize("size", ["compiled", "split", "broadcast", "shuffled"])
def test_lookup_and_phrase_search(spark, size, request):
    if size != "inline":
        request.getfixturevalue(size)
    lexicon = words(spark, "red apple", "apple tree", "apple", "pear")
    terms = spark.createDataFrame([("apple",), (" apple",), ("plum",)], "term string")
    found = {r.term: r.word_id is not None for r in match.lookup(terms, lexicon).collect()}
    assert found == {"apple": True, " apple": False, "plum": False}
    assert {r.word for r in match.phrase_search(lexicon, "apple").collect()} == {"red apple", "apple tree", "apple"}
    asked = spark.createDataFrame([("apple",), ("e",), ("",), ("e",)], "query string")
    got = sorted((r.query, r.word) for r in match.phrase_search_many(asked, lexicon).collect())
    assert got == sorted((q, w) for q in ("apple", "e") for w in ("red apple", "apple tree", "apple", "pear") if q in w)


@pytest.mark.parametrize("size", ["inline", "compiled", "split", "shuffled"])
@pytest.mark.parametrize("mode", ["words", "segmented", "anywhere"])
def test_verdicts_need_no_key(spark, size, mode, request):
    """Constant and null keys, and repeated texts: a verdict hangs on the text alone."""
    if size != "inline":
        request.getfixturevalue(size)
    rows = [("word", "you trash"), ("word", "have a nice day"), (None, "such an idiot"), (None, "good morning"), (None, None), ("word", "you trash")]
    df = spark.createDataFrame(rows, "key string, t string")
    got = match.flag_messages(df, F.col("t"), insult_lexicon(spark), mode=mode).collect()
    want = [(k, t, None if t is None else "trash" in t or "idiot" in t) for k, t in rows]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


@pytest.mark.parametrize("size", ["inline", "compiled", "split", "shuffled"])
def test_defaults_for_all_scripts(spark, size, request):
    if size != "inline":
        request.getfixturevalue(size)
    texts = ["you Trash", "such an idiot!", "nice day", "tanie ŁÓDŹ x", "скажи привет", "大红苹果甜", "大红苹果树", "a  bad, word here", "badword", "bad"]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    lexicon = words(spark, "Trash", "idiot", "Łódź", "привет", "苹果", "bad word")
    got = match.flag_messages(rows, F.col("t"), lexicon, dictionary=words(spark, "苹果树")).where("is_sensitive").collect()
    assert {r.i for r in got} == {0, 1, 3, 4, 5, 7}


def test_words_without_blanks_are_refused(spark, rows):
    with pytest.raises(ValueError, match="blanks"):
        match.flag_messages(rows, F.col("t"), insult_lexicon(spark), "filter", "words")


@pytest.mark.parametrize("size", ["inline", "compiled", "split", "shuffled"])
def test_a_covered_word_is_not_widened(spark, size, request):
    if size != "inline":
        request.getfixturevalue(size)
    rows = spark.createDataFrame([(0, "the classroom"), (1, "an ass"), (2, None), (3, "")], "i int, t string")
    got = match.widened_match(rows, ["i"], F.col("t"), words(spark, "ass"), words(spark, "classroom", "ass")).collect()
    assert [(r.i, r.word, r.widened) for r in got] == [(1, "ass", "ass")]


# --- automata ---------------------------------------------------------------------------------


def plain_hits(entries, text):
    return sorted((i, w) for w in entries for i in range(len(text)) if w and text.startswith(w, i))


@pytest.mark.parametrize("limit", [8, 4_000_000])
def test_automaton_finds_all_entries_at_all_places(spark, monkeypatch, limit):
    from wordsieve.operators import automaton, joins

    monkeypatch.setattr(joins, "AUTOMATON_CHARS", limit)
    monkeypatch.setattr(joins, "AUTOMATON_PARTS", 1000)
    monkeypatch.setattr(automaton, "BLOCK_CHARS", 20)
    rng = random.Random(4)
    for _ in range(10):
        letters = rng.choice(["ab", "abcdefgh", "aé苹🙂￿\U0010ffff "])
        entries = {"".join(rng.choices(letters, k=rng.randint(1, 6))) for _ in range(rng.randint(0, 40))} | {""}
        texts = ["".join(rng.choices(letters + "x", k=rng.randint(0, 40))) for _ in range(15)] + [None, ""]
        automata = [type("Held", (), {"value": a}) for a in ([automaton.Automaton(sorted(entries))] if limit > 8 else [automaton.Automaton([e]) for e in entries])]
        found = [hit for block in automaton.found_at(automata, texts) for hit in zip(*block)]
        for k, text in enumerate(texts):
            got = sorted((int(s), text[s : s + m]) for r, s, m in found if r == k)
            assert got == plain_hits(entries, text or "")


def test_large_dictionaries_are_split_or_joined(spark, monkeypatch):
    from wordsieve.operators import automaton, joins

    words = spark.createDataFrame([(f"word{k}",) for k in range(100)] + [("",), (None,)], "word string")
    assert len(automaton.compiled(words)) == 1
    monkeypatch.setattr(joins, "AUTOMATON_CHARS", 300)
    parts = automaton.compiled(words)
    assert len(parts) == 3 and sum(len(p.value.words) for p in parts) == 100
    monkeypatch.setattr(joins, "AUTOMATON_PARTS", 2)
    assert automaton.compiled(words) is None


@pytest.mark.parametrize("size", ["compiled", "split", "shuffled"])
@pytest.mark.parametrize("mode", ["words", "segmented", "anywhere"])
def test_verdicts_agree_with_the_set_in_the_plan(spark, request, monkeypatch, size, mode):
    rng = random.Random(8)
    pieces = ["sour", "milk", "sour milk", "milksour", "苹果", "红苹果树", "苹果树", "红", "a", "ß", "naïve", "3苹果", "İ", "x"]
    texts = [rng.choice([" ", "", ", "]).join(rng.choices(pieces, k=rng.randint(0, 5))) for _ in range(60)] + [None, "", " "]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "id int, text string")
    lex = spark.createDataFrame([("sour milk",), ("苹果",), ("naïve",), ("ß",), ("红苹果",), ("3苹果",), ("",), ("!!",)], "word string")
    dictionary = spark.createDataFrame([("苹果树",), ("milksour",)], "word string")
    judge = lambda: {r.id: r.is_sensitive for r in match.flag_messages(df, F.col("text"), lex, None, mode, dictionary).collect()}
    want = judge()
    assert {True, False, None} <= set(want.values())
    request.getfixturevalue(size)
    assert judge() == want


def test_automaton_verdict_needs_no_shuffle(spark, compiled):
    df = spark.createDataFrame([(1, "sour milk")], "id int, text string")
    lex = spark.createDataFrame([("milk",)], "word string")
    plan = match.flag_messages(df, F.col("text"), lex)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


@pytest.mark.parametrize("passes", [1, 16])
def test_dictionaries_beyond_the_automata_of_a_task_take_several_passes(spark, monkeypatch, passes):
    from wordsieve.operators import automaton, joins, segment

    monkeypatch.setattr(joins, "AUTOMATON_CHARS", 300)
    monkeypatch.setattr(joins, "AUTOMATON_PARTS", 2)
    monkeypatch.setattr(joins, "AUTOMATON_PASSES", passes)
    monkeypatch.setattr(automaton, "LEAVING_HITS", 3)
    entries = [f"word{k}" for k in range(100)] + [f"{chr(97 + k % 26)}{k}" for k in range(200)]
    words = spark.createDataFrame([(w,) for w in [*entries, entries[0]]], "word string")
    text = "xword12 q16word7" * 3
    df = spark.createDataFrame([(1, text), (2, None), (3, "")], "id int, text string")
    groups = automaton.compiled_passes(words)
    assert groups is None if passes == 1 else len(groups) > 1 and max(map(len, groups)) <= 2
    found = segment.find_all(df, ["id"], F.col("text"), words)
    assert sorted((r.start, r.word) for r in found.collect()) == sorted(plain_hits(set(entries), text))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert passes == 1 or "Exchange" not in plan


def test_whole_words_beyond_the_automata_are_looked_up_without_a_join(spark, monkeypatch):
    """A table of whole words takes 16 bytes a word, whatever their length."""
    from wordsieve.operators import automaton, joins

    monkeypatch.setattr(joins, "INLINE_WORDS", 0)
    monkeypatch.setattr(joins, "AUTOMATON_CHARS", 50)
    lex = spark.createDataFrame([(f"longword{k:020d}",) for k in range(60)] + [("two words",)], "word string")
    df = spark.createDataFrame([(1, f"a longword{3:020d}!"), (2, "two, words"), (3, "two"), (4, None), (5, "")], "id int, text string")
    assert automaton.compiled(lex) is None
    flagged = match.flag_messages(df, F.col("text"), lex)
    plan = flagged._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan
    assert {r.id: r.is_sensitive for r in flagged.collect()} == {1: True, 2: True, 3: False, 4: None, 5: False}


def test_entries_that_share_a_number_are_told_apart():
    import numpy as np

    from wordsieve.operators.automaton import Table

    table = Table(np.array([7, -1, 7]), np.array([1, 2, 3]))
    assert table.holds(np.array([7, 7, 7, -1, 0]), np.array([3, 1, 2, 2, 2])).tolist() == [True, True, False, True, False]
    assert not Table(np.zeros(0, np.int64), np.zeros(0, np.int64)).holds(np.array([0]), np.array([0])).any()


def _gathered(monkeypatch):
    """The sizes of the tables of words that the driver gathers from now on."""
    from wordsieve.operators import automaton

    sizes, made = [], automaton.Table.__init__

    def noted(table, first, second):
        sizes.append(len(first))
        made(table, first, second)

    monkeypatch.setattr(automaton.Table, "__init__", noted)
    return sizes


@pytest.mark.parametrize("most", [0, 10])
@pytest.mark.parametrize("mode", ["words", "segmented"])
def test_of_a_large_lexicon_only_held_words_are_gathered(spark, monkeypatch, mode, most):
    """The driver has no room for all entries; a verdict is the same as by the set in the plan, also where the held ones are too many."""
    from wordsieve.operators import joins

    entries = [(f"word{k}",) for k in range(500)] + [("bad word",), ("Łódź",), ("苹果",), ("",), (None,), ("!!",), ("word7",)]
    lex = spark.createDataFrame(entries, "word string")
    texts = ["a word12, WORD7", "bad, word", "bad", "word", "word499x", "", None, "tanie łódź", "大红苹果树", "大红苹果甜", "word12"]
    df = spark.createDataFrame([("k" if k % 2 else None, t) for k, t in enumerate(texts)], "key string, text string")
    dictionary = spark.createDataFrame([("苹果树",)], "word string")
    judge = lambda: sorted(map(str, match.flag_messages(df, F.col("text"), lex, None, mode, dictionary).collect()))
    want = judge()
    monkeypatch.setattr(joins, "INLINE_WORDS", 0)
    monkeypatch.setattr(joins, "TABLE_WORDS", most, raising=False)
    sizes = _gathered(monkeypatch)
    assert judge() == want
    assert sizes == ([4] if most else [])


def test_a_large_lexicon_comes_as_columns(spark, monkeypatch):
    """Rows of Python objects took some 1.5 KB of the driver a word."""
    from pyspark.sql.classic.dataframe import DataFrame

    from wordsieve.operators import automaton

    def refuse(*_):
        raise AssertionError("rows of the table are gathered one by one")

    words = spark.range(6000).select(F.concat(F.lit("w"), "id").alias("word"))
    monkeypatch.setattr(DataFrame, "toPandas", refuse)
    monkeypatch.setattr(DataFrame, "collect", refuse)
    assert len(automaton.hashed(words).value.first) == 6000
