"""What a running stream keeps: words it has seen, and the model it takes up."""

import pytest
from pyspark.sql import functions as F

from wordsieve.operators import classify, models
from wordsieve.sources import commits
from wordsieve.sources import messages as queue
from wordsieve.streaming import discovery, novelty


@pytest.fixture
def store(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, novelty.STORE)
    yield
    spark.conf.set(key, before)


def arrive(spark, path, *words):
    spark.createDataFrame([(w,) for w in words], "word string").coalesce(1).write.mode("append").parquet(path)


def run(spark, tmp_path, known=None, ttl_ms=None):
    stream = spark.readStream.schema("word string").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    queue.write_stream(novelty.new_words(stream, known, ttl_ms), "parquet", {}, f"{tmp_path}/p", f"{tmp_path}/out").start().awaitTermination()
    return sorted(r.word for r in spark.read.parquet(f"{tmp_path}/out").collect())


def test_words_come_once_over_batches_and_restarts(spark, store, tmp_path):
    known = spark.createDataFrame([("old",), (None,), ("old",)], "word string")
    arrive(spark, f"{tmp_path}/in", "a", "b", "a", "old", None)
    arrive(spark, f"{tmp_path}/in", "b", "c", "")
    assert run(spark, tmp_path, known) == ["", "a", "b", "c"]
    arrive(spark, f"{tmp_path}/in", "c", "old", "d")
    # The known words are in the state; the table given at a restart is not read.
    assert run(spark, tmp_path, known) == ["", "a", "b", "c", "d"]
    assert run(spark, tmp_path, known) == ["", "a", "b", "c", "d"]


def test_a_batch_that_failed_gives_its_words_once(spark, store, tmp_path):
    arrive(spark, f"{tmp_path}/in", "a", "b")
    failed, got = [], []

    def sink(batch, batch_id):
        rows = [r.word for r in batch.collect()]
        if not failed:
            failed.append(True)
            raise RuntimeError("lost")
        got.extend(rows)

    def start():
        stream = spark.readStream.schema("word string").parquet(f"{tmp_path}/in")
        novelty.new_words(stream).writeStream.foreachBatch(sink).option("checkpointLocation", f"{tmp_path}/p").trigger(availableNow=True).start().awaitTermination()

    with pytest.raises(Exception, match="lost"):
        start()
    start()
    start()
    assert sorted(got) == ["a", "b"]


def test_the_store_is_asked_for(spark, tmp_path):
    arrive(spark, f"{tmp_path}/in", "a")
    key = "spark.sql.streaming.stateStore.providerClass"
    if spark.conf.get(key) != novelty.STORE:
        with pytest.raises(ValueError):
            novelty.new_words(spark.readStream.schema("word string").parquet(f"{tmp_path}/in"))


def test_repetitions_go_inside_a_batch(spark):
    rows = spark.createDataFrame([("a",)] * 5000 + [("b",)], "word string").coalesce(1)
    assert novelty.once_per_batch(rows).count() <= 4


def test_messages_of_a_discovery_are_dealt_if_asked(spark, tmp_path):
    path, parts = f"{tmp_path}/in", []
    spark.createDataFrame([(f"plain text {k}",) for k in range(40)], "value string").coalesce(1).write.parquet(path)
    fitted = model(spark)
    for deal in (False, True):
        stream = spark.readStream.schema("value string").parquet(path)
        archive = f"{tmp_path}/archive{deal}"
        discovery.discovery_stream(stream, fitted, lambda rows, n: rows.count(), f"{tmp_path}/p{deal}", archive, path=None, deal=deal).start().awaitTermination()
        texts = spark.read.text(archive)
        parts.append((texts.count(), len(texts.inputFiles())))
    assert parts == [(40, 1), (40, spark.sparkContext.defaultParallelism)]


# --- models -----------------------------------------------------------------------------------


def model(spark, flipped=False, buckets=4096):
    rows = [([w], float((w in ("vile", "scum")) != flipped)) for w in ("vile", "scum", "tree", "house")]
    return classify.fit_naive_bayes(spark.createDataFrame(rows, "word array<string>, label double"), buckets, "md5")


def test_newest_usable_model(spark, tmp_path):
    path = str(tmp_path / "models")
    newest = models.Newest(spark, path)
    with pytest.raises(LookupError):
        newest()
    assert models.publish(spark, path, model(spark)) == 1
    first = newest()
    assert newest() is first and newest.number == 1
    # Broken ones: a folder that isn't there, and parts that don't fit.
    commits.put(spark, f"{path}/commits", 2, {"model": str(tmp_path / "nowhere")})
    small, large = model(spark, buckets=4096), model(spark, buckets=5000)
    mixed = small.copy()
    mixed.stages = [*small.stages[:-1], large.stages[-1]]
    models.publish(spark, path, mixed)
    assert newest() is first and newest() is first and set(newest.refused) == {2, 3}
    assert models.publish(spark, path, model(spark, True)) == 4
    assert newest() is not first and newest.number == 4


def test_a_running_stream_changes_its_verdict(spark, tmp_path):
    path, inn = str(tmp_path / "models"), f"{tmp_path}/in"
    models.publish(spark, path, model(spark))
    found = {}

    def keep(words, batch_id):
        found[batch_id] = sorted(r.word for r in words.collect())

    def send(text):
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("append").parquet(inn)

    send("vile tree")
    stream = spark.readStream.schema("value string").parquet(inn)
    running = discovery.discovery_stream(stream, models.Newest(spark, path), keep, f"{tmp_path}/p", path=None, every="0 seconds").start()
    try:
        running.processAllAvailable()
        commits.put(spark, f"{path}/commits", 2, {"model": "broken"})
        send("scum house")
        running.processAllAvailable()
        models.publish(spark, path, model(spark, True))
        send("vile tree house")
        running.processAllAvailable()
    finally:
        running.stop()
    assert list(found.values()) == [["vile"], ["scum"], ["house", "tree"]]
