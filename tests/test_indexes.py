"""The stored index of phrases and the counts that follow a stream."""

import os
import random

import pytest
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from wordsieve.operators import features, grams, snapshots
from wordsieve.operators.match import phrase_search_many
from wordsieve.streaming import frequencies

BUCKETS = 40


def commit(spark, path, words, op="add"):
    return snapshots.commit(spark, path, spark.createDataFrame([(w, "c", op) for w in words], "word string, category string, op string"))


def check(spark, lexicon, index, queries):
    asked = spark.createDataFrame([(q,) for q in queries], "query string")
    want = phrase_search_many(asked, snapshots.current(spark, lexicon)).collect()
    got = grams.search(spark, index, asked).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))
    return len(got)


def files(path):
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names}


def test_phrase_index_follows_the_lexicon(spark, tmp_path):
    lexicon, index = str(tmp_path / "lexicon"), str(tmp_path / "index")
    rng = random.Random(2)
    words = sorted({"".join(rng.choices("abcé苹", k=rng.randint(1, 8))) for _ in range(200)})
    queries = [*words[::9], "a", "ab", "abc", "é苹", "zz", "abcz", "", None, "苹"]
    assert grams.search(spark, index, spark.createDataFrame([("a",)], "query string")).collect() == []
    commit(spark, lexicon, [*words[:150], "", None])
    assert grams.follow(spark, lexicon, index) == 1 and check(spark, lexicon, index, queries) > 100
    before = files(index)
    commit(spark, lexicon, words[:60], "delete")
    commit(spark, lexicon, words[40:50])
    commit(spark, lexicon, words[150:])
    assert grams.follow(spark, lexicon, index) == 4 == grams.follow(spark, lexicon, index)
    check(spark, lexicon, index, queries)
    # What was there is not touched.
    assert before.items() <= files(index).items()
    snapshots.compact(spark, lexicon)
    snapshots.clear(spark, lexicon)
    commit(spark, lexicon, ["abab"])
    grams.follow(spark, lexicon, index)
    assert check(spark, lexicon, index, queries) == 2


def test_a_new_version_writes_only_its_own_grams(spark, tmp_path):
    lexicon, index = str(tmp_path / "lexicon"), str(tmp_path / "index")
    commit(spark, lexicon, ["abcdef", "xyz"])
    grams.follow(spark, lexicon, index)
    commit(spark, lexicon, ["abq"])
    before = set(os.listdir(f"{index}/data"))
    grams.follow(spark, lexicon, index)
    (new,) = set(os.listdir(f"{index}/data")) - before
    got = {r.gram for r in spark.read.parquet(f"{index}/data/{new}/postings").collect()}
    assert got == {"a", "b", "q", "ab", "bq", "abq"}


DOCS = [(1, ["a", "b", "a"]), (2, ["b"]), (3, []), (4, ["c", "d", "e"]), (5, ["a"]), (6, None)]


@pytest.mark.parametrize("order", [[0, 1, 2], [2, 1, 0], [1, 0, 1, 2, 2]])
@pytest.mark.parametrize("upto", [None, 0])
def test_frequencies_equal_a_fit_to_all(spark, tmp_path, order, upto):
    path = str(tmp_path / "counts")
    rows = spark.createDataFrame([(k, w) for k, w in DOCS if w is not None], "doc_id int, word array<string>")
    model = Pipeline(stages=[*features.tf_stages(spark, BUCKETS, "md5"), features.idf_stage()]).fit(rows)
    for batch in order:
        frequencies.count_batch(rows.where(F.col("doc_id") % 3 == batch), F.col("word"), path, batch, BUCKETS)
    if upto is not None:
        frequencies.compact(spark, path, 0)
        frequencies.compact(spark, path, 1)
    values = lambda m: sorted((r.doc_id, r.bucket, round(r.value, 9)) for r in features.vector_rows(m.transform(rows), ["doc_id"]).collect())
    fresh = frequencies.refreshed(spark, model, path, BUCKETS)
    assert values(fresh) == values(model)
    assert values(frequencies.refreshed(spark, fresh, path, BUCKETS)) == values(model)
    assert {(r.word, r.n) for r in frequencies.vocabulary(spark, path).collect()} == {("a", 3), ("b", 2), ("c", 1), ("d", 1), ("e", 1)}


def test_a_batch_that_changed_replaces_its_counts(spark, tmp_path):
    path = str(tmp_path / "counts")
    for words in (["a", "b"], ["c"]):
        frequencies.count_batch(spark.createDataFrame([(words,), (None,)], "word array<string>"), F.col("word"), path, 0, BUCKETS)
    assert {(r.word, r.n) for r in frequencies.vocabulary(spark, path).collect()} == {("c", 1)}


def test_rows_of_a_table_are_dealt_by_its_size(spark, tmp_path, monkeypatch):
    from wordsieve.sources import commits, tables

    spark.range(4000).selectExpr("id", "md5(cast(id AS string)) AS text").repartition(2).write.parquet(f"{tmp_path}/t.parquet")
    size = commits.size_of(spark, f"{tmp_path}/t.parquet")
    assert size > 100_000
    monkeypatch.setattr(tables, "PIECE", size // 10)
    rows = tables.read_table(spark, str(tmp_path), "t", ["id"], pieces=True)
    assert rows.rdd.getNumPartitions() >= 10 and rows.distinct().count() == 4000
