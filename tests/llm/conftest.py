import random

import duckdb
import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)

SYLLABLES = "ta re mi ko lu san vel dro pin esh ard".split()


def word(rng):
    return "".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4)))


def prose(rng, n, lines=1):
    words = [word(rng) for _ in range(n)]
    for _ in range(lines - 1):
        words[rng.randrange(n)] += "\n"
    return " ".join(words)


def edited(rng, text, changes):
    words = text.split(" ")
    for _ in range(changes):
        words[rng.randrange(len(words))] = word(rng) + "x"
    return " ".join(words)


@pytest.fixture
def rng():
    return random.Random(11)


@pytest.fixture
def docs(spark):
    from wordsieve.llm.common import ship

    ship(spark)

    def make(rows):
        full = [(i, t, "en", s, None if t is None else len(t)) for i, t, s in rows]
        return spark.createDataFrame(full, DOCS).repartition(3)

    return make


@pytest.fixture(autouse=True)
def other_tables(request, monkeypatch):
    """The SQL of some queries reads tables of which their test makes no view."""
    base, connect = getattr(request.module, "BASE", None), duckdb.connect

    def connected(*args, **options):
        con = connect(*args, **options)
        for name in ("benchmark", "conversations"):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{base}/{name}.parquet'")
        return con

    if base:
        monkeypatch.setattr(duckdb, "connect", connected)
