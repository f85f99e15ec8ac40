import json
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from wordsieve.fixtures import insult_lexicon
from wordsieve.functions import messages as J
from wordsieve.operators import classify
from wordsieve.operators import lexicon as L
from wordsieve.session import scratch_dir
from wordsieve.streaming import discovery, flagging

SCHEMA = "key string, value string"


def send(spark, folder, name, texts):
    rows = spark.createDataFrame([(f"{name}{i}", t) for i, t in enumerate(texts)], "key string, text string")
    rows.select("key", J.wrap(F.col("text")).alias("value")).coalesce(1).write.parquet(f"{folder}/{name}")


def arriving(spark, folder, per_batch=1):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", per_batch).parquet(f"{folder}/*")


def run(writer):
    query = writer.start()
    query.awaitTermination()
    assert query.exception() is None


def test_lexicon_changes_and_restart(spark, tmp_path):
    inbox, words, out, progress = (str(tmp_path / p) for p in ("in", "words", "out", "progress"))
    L.append_version(insult_lexicon(spark).withColumn("op", F.lit("add")), words, 1)
    send(spark, inbox, "a", ["you clown", "you pear"])
    send(spark, inbox, "b", ["fine", ""])

    def go():
        run(
            flagging.flag_stream(
                arriving(spark, inbox), lambda: L.current(L.read_versions(spark, words)),
                flagging.batch_files(out), progress, profile="train",
            )
        )

    go()
    assert {r.batch_id for r in spark.read.parquet(out).collect()} == {0, 1}
    more = spark.createDataFrame([("pear", "c", "add"), ("clown", "c", "delete")], "word string, category string, op string")
    L.append_version(more, words, 2)
    send(spark, inbox, "c", ["you clown", "you pear"])
    go()
    go()
    got = {r.key: r.is_sensitive for r in spark.read.parquet(out).collect()}
    assert got == {"a0": True, "a1": False, "b0": False, "b1": False, "c0": False, "c1": True}
    assert spark.read.parquet(out).count() == 6
    value = spark.read.parquet(out).where("key = 'a0'").first().value
    assert json.loads(value) == {"content": {"content": "you clown"}, "isSensitive": True}


def test_a_stream_gathers_only_the_words_its_batches_hold(spark, tmp_path, monkeypatch):
    """A lexicon of more words than the driver should gather, over several batches."""
    from wordsieve.operators import automaton, joins

    sizes, made = [], automaton.Table.__init__

    def noted(table, first, second):
        sizes.append(len(first))
        made(table, first, second)

    monkeypatch.setattr(automaton.Table, "__init__", noted)
    monkeypatch.setattr(joins, "INLINE_WORDS", 0)
    monkeypatch.setattr(joins, "TABLE_WORDS", 10, raising=False)
    inbox, out, progress = (str(tmp_path / p) for p in ("in", "out", "progress"))
    listed = spark.range(500).select(F.concat(F.lit("word"), "id").alias("word"))
    send(spark, inbox, "a", ["a word1 here", "nothing", "word2 and word2"])
    send(spark, inbox, "b", ["", "WORD499!", "word500"])
    run(flagging.flag_stream(arriving(spark, inbox), lambda: listed, flagging.batch_files(out), progress))
    assert {r.key for r in spark.read.parquet(out).where("is_sensitive").collect()} == {"a0", "a2", "b1"}
    assert spark.read.parquet(out).count() == 6
    assert sizes == [2, 1]


def test_route_splits_the_stream(spark, tmp_path):
    inbox, clean, flagged = (str(tmp_path / p) for p in ("in", "clean", "flagged"))
    send(spark, inbox, "a", ["you clown", "ok", "fine"])
    sink = flagging.route(flagging.batch_files(clean), flagging.batch_files(flagged))
    run(flagging.flag_stream(arriving(spark, inbox), lambda: insult_lexicon(spark), sink, str(tmp_path / "p"), profile="train"))
    assert {r.key for r in spark.read.parquet(clean).collect()} == {"a1", "a2"}
    assert {r.key for r in spark.read.parquet(flagged).collect()} == {"a0"}


@pytest.fixture(scope="module")
def model(spark):
    rows = [([w], 1.0) for w in ["bad", "worse", "worst"]] + [([w], 0.0) for w in ["good", "fine", "ok", "so"]]
    return classify.fit_naive_bayes(spark.createDataFrame(rows, "word array<string>, label double"), 1000)


def test_discovery_adds_each_word_once(spark, tmp_path, model):
    inbox, candidates, archive, progress = (str(tmp_path / p) for p in ("in", "cand", "arch", "progress"))
    lexicon = spark.createDataFrame([("worst",)], "word string")
    send(spark, inbox, "a", ["bad bad, good!", "worst"])
    send(spark, inbox, "b", ["so bad & worse", "fine"])

    def go():
        keep = discovery.to_candidates(spark, lambda: lexicon, candidates)
        run(discovery.discovery_stream(arriving(spark, inbox), model, keep, progress, archive, "t"))
        return sorted(r.word for r in discovery.read_candidates(spark, candidates).collect())

    assert go() == ["bad", "worse"]
    assert go() == ["bad", "worse"]
    send(spark, inbox, "c", ["worse bad", ""])
    assert go() == ["bad", "worse"]
    lines = spark.read.text(archive).where("value != ''")
    assert sorted(r.value for r in lines.collect()) == ["bad bad, good", "fine", "so bad  worse", "worse bad", "worst"]
    assert {r.topic for r in lines.collect()} == {"t"}


def test_a_retried_batch_leaves_no_copy(spark, tmp_path):
    path = str(tmp_path / "cand")
    found = spark.createDataFrame([("bad",)], "word string")
    keep = discovery.to_candidates(spark, lambda: spark.createDataFrame([], "word string"), path)
    for _ in range(2):
        keep(found, 7)
    keep(found, 8)
    assert [(r.word, r.batch_id) for r in discovery.read_candidates(spark, path).collect()] == [("bad", 7)]


def test_compacted_candidates_stay_known(spark, tmp_path):
    old, new = str(tmp_path / "old"), str(tmp_path / "new")
    none = spark.createDataFrame([], "word string")
    keep = discovery.to_candidates(spark, lambda: none, old)
    keep(spark.createDataFrame([("bad",)], "word string"), 1)
    keep(spark.createDataFrame([("worse",)], "word string"), 2)
    discovery.compact_candidates(spark, old, new)
    keep = discovery.to_candidates(spark, lambda: none, new)
    keep(spark.createDataFrame([("bad",), ("worst",)], "word string"), 3)
    got = sorted((r.word, r.batch_id) for r in discovery.read_candidates(spark, new).collect())
    assert got == [("bad", -2), ("worse", -2), ("worst", 3)]


def test_discovered_words_enter_the_lexicon(spark, tmp_path, model):
    inbox, words = str(tmp_path / "in"), str(tmp_path / "words")
    known = spark.createDataFrame([("worst", "c", "add")], "word string, category string, op string")
    L.append_version(known, words, 1)
    spark.createDataFrame([("bad worst",), ("good",)], "value string").coalesce(1).write.parquet(f"{inbox}/a")
    stream = spark.readStream.schema("value string").parquet(f"{inbox}/*")
    keep = discovery.to_lexicon(spark, words, 2)
    run(discovery.discovery_stream(stream, model, keep, str(tmp_path / "p"), path=None, profile="ascii", ngrams=True))
    keep(spark.createDataFrame([("bad",)], "word string"), 0)
    changes = L.read_versions(spark, words)
    assert sorted((r.word, r.version) for r in L.current(changes).collect()) == [("bad", 2), ("worst", 1)]


def test_ngrams_and_empty_batches(spark, tmp_path, model):
    texts = spark.createDataFrame([("a b c",)], "text string")
    grams = discovery.batch_words(texts, F.col("text"), ngrams=True)
    assert {r.word for r in grams.collect()} == {"a", "b", "ab", "abc", "c", "bc"}
    inbox, candidates = str(tmp_path / "in"), str(tmp_path / "cand")
    spark.createDataFrame([("k", ""), ("l", None)], SCHEMA).coalesce(1).write.parquet(f"{inbox}/a")
    keep = discovery.to_candidates(spark, lambda: spark.createDataFrame([], "word string"), candidates)
    run(discovery.discovery_stream(arriving(spark, inbox), model, keep, str(tmp_path / "p")))
    assert discovery.read_candidates(spark, candidates).isEmpty()
    assert {p.name for p in (tmp_path / "cand").iterdir() if p.is_dir()} == {"batch_id=-1"}


def session_with(master, **settings):
    conf = SimpleNamespace(get=lambda key, default=None: settings.get(key.replace(".", "_"), default))
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master, getConf=lambda: conf))


def test_scratch_follows_the_session(spark):
    assert scratch_dir(spark, "x") != scratch_dir(spark, "x")
    assert scratch_dir(session_with("yarn", spark_checkpoint_dir="hdfs://x/y/"), "x").startswith("hdfs://x/y/x-")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_dir(session_with("yarn"), "x")
