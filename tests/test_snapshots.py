"""Versions of a lexicon behind a pointer: writers at once, readers meanwhile, crashes, compaction."""

from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from wordsieve.operators import snapshots
from wordsieve.sources import commits
from wordsieve.streaming import discovery


def adds(spark, *words, op="add"):
    return spark.createDataFrame([(w, "c", op) for w in words], "word string, category string, op string")


def words(df):
    return sorted(r.word for r in df.collect())


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "lexicon")


def test_versions(spark, path):
    assert words(snapshots.current(spark, path)) == [] and snapshots.head(spark, path).number == 0
    assert snapshots.commit(spark, path, adds(spark, "a", "b", "b", "", None)) == 1
    assert snapshots.commit(spark, path, adds(spark, "b", op="delete"), "review") == 2
    assert snapshots.commit(spark, path, adds(spark, "b", "c")) == 3
    assert words(snapshots.current(spark, path)) == ["a", "b", "c"]
    assert words(snapshots.current(spark, path, 2)) == ["a"]
    assert words(snapshots.current(spark, path, 0)) == []
    assert {(r.word, r.version) for r in snapshots.current(spark, path).collect()} == {("a", 1), ("b", 3), ("c", 3)}
    assert {(r.word, r.version) for r in snapshots.delta(spark, path, 1).collect()} == {("b", 3), ("c", 3)}


def test_clear_is_a_version(spark, path):
    assert snapshots.clear(spark, path) == 1
    snapshots.commit(spark, path, adds(spark, "a"))
    assert snapshots.clear(spark, path) == 3
    snapshots.commit(spark, path, adds(spark, "z"))
    assert words(snapshots.current(spark, path)) == ["z"] and words(snapshots.current(spark, path, 2)) == ["a"]
    assert [(r.op, r.word) for r in snapshots.changes(spark, path, 1).orderBy("version").collect()] == [("add", "a"), ("clear", None), ("add", "z")]


def test_writers_at_once_take_numbers_apart(spark, path):
    with ThreadPoolExecutor(6) as pool:
        numbers = list(pool.map(lambda k: snapshots.commit(spark, path, adds(spark, f"w{k}"), f"writer{k % 3}"), range(12)))
    assert sorted(numbers) == list(range(1, 13)) == commits.numbers(spark, f"{path}/commits")
    assert len(words(snapshots.current(spark, path))) == 12


def test_expected_version(spark, path):
    snapshots.commit(spark, path, adds(spark, "a"))
    snapshots.commit(spark, path, adds(spark, "b"))
    with pytest.raises(snapshots.Conflict):
        snapshots.commit(spark, path, adds(spark, "c"), expected=1)
    assert snapshots.commit(spark, path, adds(spark, "c"), expected=2) == 3


def test_reader_keeps_its_version_while_others_write(spark, path):
    snapshots.commit(spark, path, adds(spark, "a"))
    held = snapshots.current(spark, path)
    snapshots.commit(spark, path, adds(spark, "b"))
    snapshots.compact(spark, path)
    snapshots.clear(spark, path)
    assert words(held) == ["a"]


def test_a_writer_lost_before_the_pointer_leaves_nothing(spark, path, monkeypatch):
    snapshots.commit(spark, path, adds(spark, "a"))

    def lost(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(commits, "put", lost)
        with pytest.raises(RuntimeError):
            snapshots.commit(spark, path, adds(spark, "half"))
    assert words(snapshots.current(spark, path)) == ["a"]
    assert snapshots.commit(spark, path, adds(spark, "b")) == 2
    assert words(snapshots.current(spark, path)) == ["a", "b"]


def test_compaction_keeps_words_and_changes(spark, path):
    snapshots.commit(spark, path, adds(spark, "a", "b"))
    snapshots.commit(spark, path, adds(spark, "a", op="delete"))
    before = snapshots.delta(spark, path, 0).collect()
    assert snapshots.compact(spark, path) == 3
    assert snapshots.head(spark, path).deltas == ()
    assert words(snapshots.current(spark, path)) == ["b"] and words(snapshots.current(spark, path, 1)) == ["a", "b"]
    assert sorted(snapshots.delta(spark, path, 0).collect()) == sorted(before)
    snapshots.commit(spark, path, adds(spark, "a"))
    assert {(r.word, r.version) for r in snapshots.current(spark, path).collect()} == {("a", 4), ("b", 1)}


@pytest.mark.parametrize("meanwhile", ["commit", "clear", "compact"])
def test_compaction_beside_another_writer(spark, path, monkeypatch, meanwhile):
    snapshots.commit(spark, path, adds(spark, "a"))
    words_of = snapshots._words

    def slow(spark, version):
        found = words_of(spark, version)
        monkeypatch.setattr(snapshots, "_words", words_of)
        if meanwhile == "commit":
            snapshots.commit(spark, path, adds(spark, "late"))
        else:
            getattr(snapshots, meanwhile)(spark, path)
        return found

    monkeypatch.setattr(snapshots, "_words", slow)
    assert snapshots.compact(spark, path) == (3 if meanwhile == "commit" else None)
    assert words(snapshots.current(spark, path)) == {"commit": ["a", "late"], "clear": [], "compact": ["a"]}[meanwhile]


def test_a_batch_that_is_run_again_commits_once(spark, path):
    snapshots.commit(spark, path, adds(spark, "a"))
    keep = snapshots.keep_new(spark, path)
    found = spark.createDataFrame([("a",), ("x",)], "word string")
    for batch in (0, 0, 1, 1, 0):
        keep(found if batch == 0 else found.union(spark.createDataFrame([("y",)], "word string")), batch)
    assert [(r.word, r.version) for r in snapshots.delta(spark, path, 1).orderBy("version").collect()] == [("x", 2), ("y", 3)]


def test_rename_without_overwriting(spark, tmp_path):
    """The way that commits go where there are no links."""
    folder = f"file:{tmp_path}/commits"
    assert commits._renamed(spark, folder, 1, '{"n": 1}') and not commits._renamed(spark, folder, 1, '{"n": 2}')
    assert commits.latest(spark, folder) == (1, {"n": 1}) and commits.numbers(spark, folder) == [1]


def test_a_discovery_stream_extends_it(spark, path, tmp_path):
    snapshots.commit(spark, path, adds(spark, "old"))
    keep = snapshots.keep_new(spark, path)
    spark.createDataFrame([("new old words",), ("new again",)], "text string").write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("text string").parquet(f"{tmp_path}/in")
    run = lambda b, n: keep(discovery.batch_words(b, F.col("text")), n)
    for _ in range(2):
        stream.writeStream.foreachBatch(run).option("checkpointLocation", f"{tmp_path}/progress").trigger(availableNow=True).start().awaitTermination()
    assert words(snapshots.current(spark, path)) == ["again", "new", "old", "words"]


def test_a_stream_gets_the_same_frame_until_there_is_a_newer_version(spark, path):
    newest = snapshots.Newest(spark, path)
    assert words(newest()) == []
    snapshots.commit(spark, path, adds(spark, "a"))
    first = newest()
    assert words(first) == ["a"] and newest() is first
    snapshots.commit(spark, path, adds(spark, "b"))
    assert newest() is not first and words(newest()) == ["a", "b"]


def test_candidates_are_summed_up_as_a_stream_goes_on(spark, tmp_path):
    path = f"{tmp_path}/candidates"
    listed = spark.createDataFrame([("listed",)], "word string")
    keep = discovery.to_candidates(spark, lambda: listed, path, 3)
    found = lambda *w: spark.createDataFrame([(x,) for x in w], "word string")
    for batch in range(8):
        for _ in range(1 + batch % 2):
            keep(found("listed", "always", f"w{batch}", f"w{batch - 1}"), batch)
    rows = discovery.read_candidates(spark, path).collect()
    assert sorted(r.word for r in rows) == sorted(["always", "w-1", *(f"w{k}" for k in range(8))])
    assert {r.batch_id for r in rows} == {-2, 6, 7} and commits.latest(spark, f"{path}/_commits")[1]["upto"] == 5
