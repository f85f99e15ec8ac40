"""Queues: outbox and inbox, the spool, rejects and counts of a running stream, with restarts in between."""

import json
import os

import pytest
from pyspark.sql import functions as F

from wordsieve.fixtures import insult_lexicon
from wordsieve.functions import messages as J
from wordsieve.sources import messages as queue
from wordsieve.sources import spool
from wordsieve.streaming import flagging, outbox

SENT = "sent_batch bigint, sent_seq bigint, key string, value string"


def put(spark, path, texts, key="k"):
    rows = spark.createDataFrame([(key, t) for t in texts], "key string, text string")
    rows.select("key", J.wrap(F.col("text")).alias("value")).coalesce(1).write.mode("append").parquet(path)


def source(spark, path):
    return spark.readStream.schema("key string, value string").option("maxFilesPerTrigger", 1).parquet(path)


def received(spark, path):
    return sorted(r.text for r in spark.read.parquet(path).select(J.extract_strict(F.col("value")).alias("text")).collect())


@pytest.mark.parametrize("crash", ["before", "half", "after"])
def test_a_batch_killed_between_send_and_commit_arrives_once(spark, tmp_path, crash):
    inn, box, sent, came, got = (f"{tmp_path}/{n}" for n in ("in", "box", "sent", "came", "got"))
    for k in range(3):
        put(spark, inn, [f"{k}-{i}" for i in range(5)])
    send, broken = flagging.queue("parquet", {"path": sent}, outbox.MESSAGE), []

    def failing(rows, batch_id):
        if batch_id == 1 and not broken:
            broken.append(True)
            if crash != "before":
                send(rows if crash == "after" else rows.limit(2), batch_id)
            raise RuntimeError("killed")
        send(rows, batch_id)

    def run():
        flagging.flag_stream(source(spark, inn), lambda: insult_lexicon(spark), outbox.outbox(box, failing), f"{tmp_path}/p1").start().awaitTermination()

    with pytest.raises(Exception, match="killed"):
        run()
    run()
    assert spark.read.parquet(sent).count() == {"before": 15, "half": 17, "after": 20}[crash]
    read = queue.read_stream(spark, "parquet", {"maxFilesPerTrigger": "1"}, sent, SENT)
    take = outbox.inbox(came, flagging.batch_files(got))
    for _ in range(2):
        read.writeStream.foreachBatch(take).option("checkpointLocation", f"{tmp_path}/p2").trigger(availableNow=True).start().awaitTermination()
    assert received(spark, got) == sorted(f"{k}-{i}" for k in range(3) for i in range(5))


def test_a_batch_that_was_sent_is_not_sent_again(spark, tmp_path):
    calls = []
    sink = outbox.outbox(f"{tmp_path}/box", lambda rows, n: calls.append((n, rows.count())))
    rows = spark.createDataFrame([("k", "a"), (None, "b")], "key string, value string")
    for batch in (0, 0, 1):
        sink(rows, batch)
    assert calls == [(0, 2), (1, 2)]


def test_an_inbox_batch_that_is_run_again_takes_the_same(spark, tmp_path):
    taken = {}
    sink = outbox.inbox(f"{tmp_path}/came", lambda rows, n: taken.__setitem__(n, sorted(r.sent_seq for r in rows.collect())))
    rows = spark.createDataFrame([(0, k, "k", "v") for k in (1, 2, 2, 3)], SENT)
    sink(rows.where("sent_seq < 3"), 0)
    sink(rows, 1)
    sink(rows, 1)
    sink(rows.where("sent_seq < 3"), 0)
    assert taken == {0: [1, 2], 1: [3]}


def test_envelope(spark):
    rows = spark.createDataFrame([(1, 2, "k", '{"a": "é"}'), (1, 3, None, None)], SENT)
    assert sorted(map(tuple, outbox.opened(outbox.enveloped(rows)).collect()), key=str) == sorted(map(tuple, rows.collect()), key=str)


# --- spool ------------------------------------------------------------------------------------


@pytest.fixture
def folder(spark, tmp_path):
    spool.use_spool(spark)
    return str(tmp_path / "spool")


def fill(spark, folder, values, parts=2):
    rows = spark.createDataFrame([(f"k{i}", v) for i, v in enumerate(values)], "key string, value string")
    rows.repartition(parts).write.format("spool").mode("append").save(folder)


def test_spool_keeps_all_messages_in_numbered_places(spark, folder):
    values = ["plain", "two\nlines", "  \x85 é 🙂", '"{', None, ""]
    fill(spark, folder, values)
    fill(spark, folder, ["later"], 1)
    rows = spark.read.format("spool").load(folder).orderBy("seq").collect()
    assert [r.seq for r in rows] == list(range(7)) and rows[-1].value == "later"
    assert sorted((r.value for r in rows), key=str) == sorted([*values, "later"], key=str)


def test_spool_of_nothing(spark, folder):
    os.makedirs(folder)
    assert spark.read.format("spool").load(folder).collect() == []


def batches(spark, folder, progress, prefetch, fail_at=None):
    """Read a spool to its end; the numbers in each batch."""
    seen = []

    def take(rows, batch_id):
        found = sorted(r.seq for r in rows.collect())
        seen.append(found)
        if fail_at is not None and fail_at in found:
            raise RuntimeError("sink failed")

    read = queue.read_stream(spark, "spool", {"prefetch": str(prefetch)}, folder)
    queue.drain(read.writeStream.foreachBatch(take).option("checkpointLocation", progress))
    return seen


def test_spool_batches_are_bounded_and_finished_in_order(spark, folder, tmp_path):
    fill(spark, folder, [str(k) for k in range(23)], 3)
    seen = batches(spark, folder, f"{tmp_path}/p", 10)
    assert [k for b in seen for k in b] == list(range(23)) and max(map(len, seen)) == 10
    fill(spark, folder, ["more"], 1)
    assert [k for b in batches(spark, folder, f"{tmp_path}/p", 10) for k in b] == [23]
    # What a reader has finished another one doesn't get: the note lags by the last batch at most.
    assert 20 <= spool.acked(folder) <= 24


def test_readers_of_a_spool_share_a_batch_and_each_begins_near_its_messages(spark, folder, tmp_path, monkeypatch):
    fill(spark, folder, [f"{k} é" for k in range(1000)], 1)
    (_, _, name), = spool.segments(folder)
    slices = spool.SpoolStream(folder, 100, 4).partitions({"seq": 250}, {"seq": 650})
    assert [(s.begin, s.end) for s in slices] == [(250, 350), (350, 450), (450, 550), (550, 650)]
    assert [spool._place(s)[0] for s in slices] == [0, 256, 256, 512]
    before = [list(spool._rows(s)) for s in slices]
    assert [r[0] for rows in before for r in rows] == list(range(250, 650))
    # A segment without its places is read from its beginning.
    os.unlink(os.path.join(folder, f"{name}.at"))
    assert [spool._place(s)[0] for s in slices] == [0] * 4 and [list(spool._rows(s)) for s in slices] == before
    seen = []
    read = queue.read_stream(spark, "spool", {"prefetch": "100", "readers": "4"}, folder)
    queue.drain(read.writeStream.foreachBatch(lambda rows, n: seen.append(rows.count())).option("checkpointLocation", f"{tmp_path}/p"))
    assert seen == [400, 400, 200]


def test_messages_that_were_not_finished_come_again(spark, folder, tmp_path):
    fill(spark, folder, [str(k) for k in range(12)], 1)
    with pytest.raises(Exception, match="sink failed"):
        batches(spark, folder, f"{tmp_path}/p", 5, fail_at=7)
    assert spool.acked(folder) <= 5
    # The same reader goes on with the batch that failed; a new one begins at the first that isn't finished.
    assert [k for b in batches(spark, folder, f"{tmp_path}/p", 5) for k in b][:1] == [5]
    again = batches(spark, folder, f"{tmp_path}/other", 5)
    assert not again or again[0][0] == spool.acked(folder) or again[0][0] <= 10


def test_marking_from_a_spool_to_a_spool(spark, folder, tmp_path):
    """Messages that can't be used go to the rejects in the same pass, and are counted by reason."""
    good = [json.dumps({"content": {"content": f"text {k} {'idiot' if k % 2 else ''}"}}) for k in range(9)]
    bad = ["{", "[]", '{"content":5}', '{"content":{"x":1}}', '{"content":{"content":null}}', None, '{"isSensitive":1,"content":{"content":"a","b":1,"b":2}}']
    fill(spark, folder, good + bad, 3)
    out, refused, counts = str(tmp_path / "out"), f"{tmp_path}/refused", {}
    read = queue.read_stream(spark, "spool", {"prefetch": "6"}, folder)
    marking = flagging.flag_stream(
        read, lambda: insult_lexicon(spark), flagging.queue("spool", {"path": out}), f"{tmp_path}/p",
        rejects=flagging.batch_files(refused), on_counts=counts.__setitem__,
    )
    queue.drain(marking)
    marked = [json.loads(r.value) for r in spark.read.format("spool").load(out).collect()]
    assert len(marked) == 9 and sum(m["isSensitive"] for m in marked) == 4
    sent = spark.read.format("spool").load(folder)
    want = {r.reason: r.n for r in flagging.reject_counts(sent, F.col("value")).collect()}
    total = {}
    for c in counts.values():
        for k, n in c.items():
            total[k] = total.get(k, 0) + n
    assert {k: n for k, n in total.items() if n and k != "used"} == want and total["used"] == 9
    assert {r.reason: r["count"] for r in spark.read.parquet(refused).groupBy("reason").count().collect()} == want
    assert len(counts) == 3


def test_a_stream_into_a_spool_adds_a_batch_once(spark, folder, tmp_path):
    inn = f"{tmp_path}/in"
    put(spark, inn, ["a", "b"])
    for _ in range(2):
        writer = queue.write_stream(source(spark, inn), "spool", {}, f"{tmp_path}/p", folder)
        writer.start().awaitTermination()
    assert spark.read.format("spool").load(folder).count() == 2
    # A driver that was lost after the batch had its place writes it again.
    write = spool.SpoolStreamWriter(folder, ["key", "value"])
    spare = os.path.join(folder, ".spare")
    with open(spare, "w") as f:
        f.write("{}\n")
    placed = {int(n.split("-")[3][:-6]) for _, _, n in spool.segments(folder)}
    write.commit([spool.Written(p, 1, spare) for p in placed], 0)
    assert spark.read.format("spool").load(folder).count() == 2 and not os.path.exists(spare)


@pytest.mark.parametrize("fmt", ["kafka", "parquet"])
def test_read_stream_and_options(spark, fmt, tmp_path, monkeypatch):
    options = queue.kafka_options("host:1", ["a", "b"], 7)
    assert options == {"kafka.bootstrap.servers": "host:1", "subscribe": "a,b", "startingOffsets": "earliest", "maxOffsetsPerTrigger": "7"}
    assert "maxOffsetsPerTrigger" not in queue.kafka_options("host:1", ["a"])
    rows = [(bytearray(b"k"), bytearray(b"v"), "t"), (None, bytearray(b""), "t"), (None, None, "t")]
    if fmt == "kafka":
        got = queue.non_empty(queue.decode(spark.createDataFrame(rows, "key binary, value binary, topic string")))
        assert [tuple(r) for r in got.collect()] == [("k", "v", "t")]
        return
    for k in range(5):
        put(spark, f"{tmp_path}/in", [str(k)])
    sizes = []
    read = queue.read_stream(spark, "parquet", {"maxFilesPerTrigger": "2"}, f"{tmp_path}/in", "key string, value string")
    writer = read.writeStream.foreachBatch(lambda b, n: sizes.append(b.count())).option("checkpointLocation", f"{tmp_path}/p")
    writer.trigger(availableNow=True).start().awaitTermination()
    assert sizes == [2, 2, 1]
