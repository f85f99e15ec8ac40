import json

import pytest
from pyspark.sql import functions as F

from wordsieve.fixtures import insult_lexicon
from wordsieve.functions import messages as J
from wordsieve.sources.messages import envelope, kafka_options, non_empty, outgoing
from wordsieve.streaming.flagging import mark_messages, reject_counts

CASES = [
    # message, lenient, strict, reason
    ('{"a":{"b":"t"}}', "t", "t", None),
    ('{"b":"t"}', "t", None, None),
    ('{"a":null,"b":"t"}', None, None, "bad_level"),
    ('{"a":5,"b":"t"}', None, None, "bad_level"),
    ('{"a":{"c":"t"}}', None, None, "missing_key"),
    ('{"a":{"b":null}}', None, None, "null_text"),
    ('{"a":"{\\"b\\":\\"t\\"}","b":"u"}', None, None, "bad_level"),
    ('{"a":[{"b":"t"}],"b":"u"}', None, None, "bad_level"),
    ('{"a":{},"b":"u"}', None, None, "missing_key"),
    ('{"a":{"b":"t","c":{"d":[1]}},"z":{"a":1}}', "t", "t", None),
    ('{"a":{"b":7}}', "7", "7", None),
    ('{"a":{"b":{"c":1}}}', '{"c":1}', '{"c":1}', None),
    ('{"a":{"b":""}}', "", "", None),
    ('{"a":{"b":"t"', None, "", "malformed"),
    ("nonsense", None, "", "malformed"),
    ("", None, "", "malformed"),
    ('[{"a":{"b":"t"}}]', None, None, "not_an_object"),
    (None, None, None, "null_message"),
]


@pytest.fixture(scope="module")
def extracted(spark):
    rows = spark.createDataFrame([(i, c[0]) for i, c in enumerate(CASES)], "i int, v string")
    path = ("a", "b")
    return {
        r.i: r
        for r in rows.select(
            "i",
            J.extract_lenient(F.col("v"), path).alias("lenient"),
            J.extract_strict(F.col("v"), path).alias("strict"),
            J.reject_reason(F.col("v"), path).alias("reason"),
        ).collect()
    }


@pytest.mark.parametrize("i", range(len(CASES)))
def test_extract(extracted, i):
    _, lenient, strict, reason = CASES[i]
    assert (extracted[i].lenient, extracted[i].strict, extracted[i].reason) == (lenient, strict, reason)


def test_three_levels_and_one(spark):
    rows = spark.createDataFrame([('{"a":{"c":"x"},"t":"y"}',)], "v string")
    row = rows.select(
        J.extract_lenient(F.col("v"), ["a", "b", "c"]).alias("deep"), J.extract_lenient(F.col("v"), ["t"]).alias("flat")
    ).first()
    assert (row.deep, row.flat) == ("x", "y")


def test_mark_keeps_other_fields(spark):
    values = ['{"b": 1.10, "c":{"d":[1,2]}} \n', '{"isSensitive":1,"a":"é\\"\\n"}', "{}", "[1]", "broken", None]
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    got = [r.m for r in rows.select("i", J.mark(F.col("v"), F.col("i") == 1).alias("m")).orderBy("i").collect()]
    assert got[0] == '{"b": 1.10, "c":{"d":[1,2]},"isSensitive":false}'
    assert json.loads(got[1]) == {"a": 'é"\n', "isSensitive": True}
    assert got[1].count("isSensitive") == 1
    assert got[2] == '{"isSensitive":false}'
    assert got[3:] == [None, None, None]


def test_mark_messages_drops_the_unusable(spark):
    values = [J_text for J_text in ('{"content":{"content":"you Clown!"}}', '{"content":{"content":""}}', "[]", "{", None)]
    rows = spark.createDataFrame([(str(i), v) for i, v in enumerate(values)], "key string, value string")
    got = {r.key: (json.loads(r.value), r.is_sensitive) for r in mark_messages(rows, insult_lexicon(spark), profile="train").collect()}
    assert got == {
        "0": ({"content": {"content": "you Clown!"}, "isSensitive": True}, True),
        "1": ({"content": {"content": ""}, "isSensitive": False}, False),
    }
    counts = {r.reason: r.n for r in reject_counts(rows, F.col("value")).collect()}
    assert counts == {"not_an_object": 1, "malformed": 1, "null_message": 1}


def test_envelope_and_outgoing(spark):
    rows = spark.createDataFrame([(bytearray("好".encode()),), (bytearray(b""),)], "body binary")
    sent = envelope(rows, F.col("body")).collect()
    assert sorted(r.payload for r in sent) == ["", "好"]
    assert len({r.msg_id for r in sent}) == 2 and all(1000 <= int(r.num) <= 9999 for r in sent)
    pairs = spark.createDataFrame([(1, "x"), (2, "")], "id int, value string")
    assert [tuple(r) for r in outgoing(non_empty(pairs), F.col("id"), F.col("value")).collect()] == [("1", "x")]
    assert {r.key for r in outgoing(pairs, F.col("id"), F.col("value"), constant_key=True).collect()} == {"word"}
    assert kafka_options("h:1", ["a", "b"], 5)["subscribe"] == "a,b"


def test_repeated_keys_are_rejected_and_stop_nothing(spark):
    values = [
        '{"x":1,"x":2,"isSensitive":0}', '{"x":{"b":1,"b":2},"isSensitive":0}', '{"isSensitive":0,"isSensitive":1}',
        '{"x":1,"x":2,"content":"idiot"}', '{"isSensitive":0,"content":"idiot"}',
    ]
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    marked = {r.i: r.m for r in rows.select("i", J.mark(F.col("v"), F.lit(True)).alias("m")).collect()}
    assert marked[0] is marked[1] is marked[2] is None
    assert marked[3] == '{"x":1,"x":2,"content":"idiot","isSensitive":true}'
    assert json.loads(marked[4]) == {"content": "idiot", "isSensitive": True}
    sent = rows.select(F.col("i").alias("key"), F.replace("v", F.lit('"x":1'), F.lit('"content":"scum","x":1')).alias("value"))
    out = mark_messages(sent, insult_lexicon(spark), path=("content",)).collect()
    assert {r.key for r in out} == {3, 4} and all(r.is_sensitive for r in out)
    counts = {r.reason: r.n for r in reject_counts(sent, F.col("value"), ("content",)).collect()}
    assert counts == {"repeated_key": 1, "missing_key": 2}
