"""A lexicon in versions that readers reach through a pointer: writers commit complete files one after the other.

A folder holds ``data`` (change sets), ``base`` (compacted lexicons) and ``commits``. A commit names all that makes up its
version: a base and the change sets since. Files that no commit names, as of a writer that was lost, are never read.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass, field, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordsieve.functions.hashing import word_id
from wordsieve.sources import commits

CHANGES = "word string, category string, op string"
WORDS = "word string, category string, version bigint"


class Conflict(RuntimeError):
    """Another writer has committed since the version that the change was meant for."""


@dataclass(frozen=True)
class Version:
    """What makes up a version: ``deltas`` are the (version, folder) of the change sets after the base."""

    number: int = 0
    kind: str = "changes"
    writer: str = ""
    own: str | None = None
    base: str | None = None
    deltas: tuple[tuple[int, str], ...] = ()
    # The last batch that each writer of numbered batches has committed.
    batches: dict[str, int] = field(default_factory=dict)


def _version(spark: SparkSession, path: str, number: int) -> Version:
    said = commits.read(spark, f"{path}/commits", number)
    return Version(**said | {"deltas": tuple(map(tuple, said["deltas"]))})


def head(spark: SparkSession, path: str) -> Version:
    """The newest version; number 0, which is empty, before the first commit."""
    known = commits.numbers(spark, f"{path}/commits")
    return _version(spark, path, known[-1]) if known else Version()


def _commit(spark: SparkSession, path: str, make: Callable[[Version], Version | None]) -> Version | None:
    """Commit what ``make`` makes of the newest version; made anew when another writer takes the number first."""
    while True:
        made = make(head(spark, path))
        if made is None or commits.put(spark, f"{path}/commits", made.number, asdict(made)):
            return made


def commit(
    spark: SparkSession, path: str, changes: DataFrame, writer: str = "main", batch: int | None = None, expected: int | None = None
) -> int:
    """Write a set of changes (word, category, op add or delete) and make it the next version, whose number is returned.

    The files are complete before the pointer moves. A numbered ``batch`` of a writer is committed once: run again it
    changes nothing. With ``expected`` the change is refused, as a Conflict, when that is not the newest version.
    """

    def done(now: Version) -> bool:
        return batch is not None and now.batches.get(writer, -1) >= batch

    now = head(spark, path)
    if done(now):
        return now.number
    own = f"{path}/data/{uuid.uuid4().hex}"
    changes.select("word", "category", "op").write.parquet(own)

    def make(now: Version) -> Version | None:
        if done(now):
            return None
        if expected is not None and now.number != expected:
            raise Conflict(f"version {now.number} is newer than {expected}")
        number = now.number + 1
        batches = now.batches if batch is None else {**now.batches, writer: batch}
        return replace(now, number=number, kind="changes", writer=writer, own=own, deltas=(*now.deltas, (number, own)), batches=batches)

    made = _commit(spark, path, make)
    return head(spark, path).number if made is None else made.number


def clear(spark: SparkSession, path: str, writer: str = "main") -> int:
    """Drop all words: the next version is empty. Older versions can still be read."""
    made = _commit(spark, path, lambda now: replace(now, number=now.number + 1, kind="clear", writer=writer, own=None, base=None, deltas=()))
    return made.number


def compact(spark: SparkSession, path: str, writer: str = "main") -> int | None:
    """Write the newest version as one base, and commit it with the change sets that came meanwhile.

    The words stay as they are, and so do the older commits, so that ``delta`` doesn't change. Where another writer has
    compacted or cleared meanwhile nothing is committed, and None returned.
    """
    start = head(spark, path)
    base = f"{path}/base/{uuid.uuid4().hex}"
    _words(spark, start).write.parquet(base)

    def make(now: Version) -> Version | None:
        if any(_version(spark, path, n).kind != "changes" for n in range(start.number + 1, now.number + 1)):
            return None
        since = tuple(d for d in now.deltas if d[0] > start.number)
        return replace(now, number=now.number + 1, kind="compact", writer=writer, own=None, base=base, deltas=since)

    made = _commit(spark, path, make)
    return None if made is None else made.number


def _words(spark: SparkSession, version: Version) -> DataFrame:
    """word, category, version. Only the change sets since the base are aggregated; the base is read as it is."""
    base = spark.read.schema(WORDS).parquet(version.base) if version.base else spark.createDataFrame([], WORDS)
    if not version.deltas:
        return base
    sets = [spark.read.schema(CHANGES).parquet(p).withColumn("version", F.lit(n).cast("bigint")) for n, p in version.deltas]
    changes = reduce(DataFrame.unionByName, sets).where(F.length("word") > 0)
    last = changes.groupBy("word").agg(F.max(F.struct("version", "op", "category")).alias("_l")).select("word", "_l.*")
    kept = base.join(last.select("word"), "word", "left_anti") if version.base else base
    return kept.select("word", "category", "version").unionByName(last.where("op = 'add'").select("word", "category", "version"))


def current(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The lexicon as of a version, the newest by default: word_id, word, category, version (of the word's last addition).

    What is read is settled by one commit, so a version stays whole whatever is written meanwhile.
    """
    asked = head(spark, path) if version is None else _version(spark, path, version) if version else Version()
    return _words(spark, asked).select(word_id(F.col("word")).alias("word_id"), "word", "category", "version")


class Newest:
    """The newest version of a lexicon for a stream: the same frame until there is a newer one."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.number, self.words = -1, None

    def __call__(self) -> DataFrame:
        now = head(self.spark, self.path)
        if now.number != self.number:
            self.number, self.words = now.number, current(self.spark, self.path, now.number)
        return self.words


def changes(spark: SparkSession, path: str, since: int, upto: int | None = None) -> DataFrame:
    """The changes after a version: word, category, op, version, in one row per change; a drop of all words has op ``clear``.

    Only the folders of the versions in question are read.
    """
    last = head(spark, path).number if upto is None else upto
    made = [_version(spark, path, n) for n in range(since + 1, last + 1)]
    none = spark.createDataFrame([(None, None, "clear", v.number) for v in made if v.kind == "clear"], f"{CHANGES}, version bigint")
    sets = [spark.read.schema(CHANGES).parquet(v.own).withColumn("version", F.lit(v.number).cast("bigint")) for v in made if v.own]
    return reduce(DataFrame.unionByName, sets, none)


def delta(spark: SparkSession, path: str, since: int) -> DataFrame:
    """Words added after a version: word, version."""
    return changes(spark, path, since).where("op = 'add'").select("word", "version")


def keep_new(spark: SparkSession, path: str, category: str = "discovered", writer: str = "discovery") -> Callable[[DataFrame, int], None]:
    """For a discovery stream: the words of a batch that are not listed become the next version, each batch once."""

    def keep(found: DataFrame, batch_id: int) -> None:
        new = found.join(current(spark, path).select("word"), "word", "left_anti")
        commit(spark, path, new.select("word", F.lit(category).alias("category"), F.lit("add").alias("op")), writer, batch_id)

    return keep
