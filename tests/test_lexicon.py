import pytest
from pyspark.sql import functions as F

from wordsieve.operators import lexicon as L
from wordsieve.sources import wordfiles


def lex(spark, *words):
    return L.as_lexicon(spark.createDataFrame([(w,) for w in words], "word string"), "c", "s")


def bag(spark, *words):
    return spark.createDataFrame([(i, w) for i, w in enumerate(words)], "i int, word string")


def found(df):
    return sorted(r.word for r in df.collect())


def test_word_files(spark, tmp_path):
    (tmp_path / "b topic.txt").write_text("﻿one\n two\t\n\nthree four\n", encoding="utf-8")
    (tmp_path / "a.txt").write_text("﻿two\r\nfive\n", encoding="utf-8")
    rows = wordfiles.load_word_files(spark, str(tmp_path)).collect()
    assert {r.word: r.category for r in rows} == {"one": "b topic", "two": "a", "three four": "b topic", "five": "a"}
    assert len({r.word_id for r in rows}) == 4


def test_read_lexicon_and_corpus(spark, tmp_path):
    bag(spark, "x", None).write.parquet(str(tmp_path / "lexicon"))
    assert found(wordfiles.read_lexicon(spark, str(tmp_path / "lexicon"))) == ["word", "x"]
    (tmp_path / "corpus.txt").write_text("l1\n\nl3\n")
    assert [r.line for r in wordfiles.read_corpus(spark, str(tmp_path / "corpus.txt")).collect()] == ["l1", "", "l3"]


def test_upsert_statuses(spark):
    status = L.upsert_status(bag(spark, "w", "w", "", "old", None, "v"), lex(spark, "old"), ["i"])
    assert [r.status for r in status.orderBy("i").collect()] == [1, 0, 2, 0, 2, 1]
    assert found(L.insert(lex(spark, "old"), bag(spark, "w", "w", "", "old"), "n", "s")) == ["old", "w"]


def test_deletes(spark):
    listed = lex(spark, "a", "b", "c")
    assert found(L.delete_words(listed, bag(spark, "a", "a", "x"))) == ["b", "c"]
    status = {r.word: r.found for r in L.delete_status(listed, bag(spark, "a", "x", "x", None)).collect()}
    assert status == {"a": True, "x": False}
    ids = listed.where("word = 'b'").select("word_id")
    assert found(L.delete_ids(listed, ids)) == ["a", "c"]
    assert L.clear(listed).schema == listed.schema and L.clear(listed).isEmpty()
    assert L.size(listed).first().size == 3
    assert found(L.list_words(listed.unionByName(listed))) == ["a", "b", "c"]


def test_review(spark):
    decisions = spark.createDataFrame(
        [("n1", "confirm"), ("n2", "delete"), ("zz", "confirm"), ("a", "delete"), ("m", "add"), ("b", "add")],
        "word string, action string",
    )
    got = L.review(lex(spark, "a", "b"), bag(spark, "n1", "n2", "n3"), decisions)
    assert found(got) == ["b", "m", "n1"]


def test_matchable(spark):
    rows = L.matchable(bag(spark, " What?? ", "WHAT", "@!", "ok")).collect()
    assert {r.word: r.entry for r in rows} == {"what": " What?? ", "ok": "ok"}


def test_versions(spark, tmp_path):
    path = str(tmp_path / "lexicon")

    def change(op, *words):
        return lex(spark, *words).withColumn("op", F.lit(op))

    L.append_version(change("add", "a", "b"), path, 1)
    L.append_version(change("add", "c"), path, 2)
    L.append_version(change("add", "c"), path, 2)
    L.append_version(change("delete", "a"), path, 3)
    changes = L.read_versions(spark, path)
    assert found(L.current(changes)) == ["b", "c"]
    assert found(L.current(changes, 1)) == ["a", "b"]
    assert found(L.delta(changes, 1)) == ["c"]
    L.append_version(change("add", "a"), path, 4)
    assert found(L.current(L.read_versions(spark, path))) == ["a", "b", "c"]
    plan = L.delta(L.read_versions(spark, path), 2)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(version" in plan


@pytest.mark.parametrize("size", ["broadcast", "shuffled"])
def test_new_words_take_the_first_arrival(spark, size, request):
    if size != "inline":
        request.getfixturevalue(size)
    new = L.new_words(bag(spark, "x", "y", "x", ""), lex(spark, "y"), ["i"])
    assert [(r.word, r.i) for r in new.collect()] == [("x", 0)]
