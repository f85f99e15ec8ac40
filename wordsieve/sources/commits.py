"""A row of numbered commits in a folder: small JSON files, each put whole or not at all, and by one writer only."""

from __future__ import annotations

import json
import os
import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _name(number: int) -> str:
    return f"{number:012d}.json"


def _files(spark: SparkSession, path: str):
    """The file system of a path, by Hadoop's names."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def size_of(spark: SparkSession, path: str) -> int:
    """The bytes of a file, or of all files in a folder."""
    fs, where = _files(spark, path)
    return fs.getContentSummary(where).getLength()


def numbers(spark: SparkSession, path: str) -> list[int]:
    """The numbers of all commits, in order."""
    fs, where = _files(spark, path)
    if not fs.exists(where):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(where)]
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def read(spark: SparkSession, path: str, number: int) -> dict:
    fs, where = _files(spark, f"{path}/{_name(number)}")
    opened = fs.open(where)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(opened, "UTF-8"))
    finally:
        opened.close()


def latest(spark: SparkSession, path: str) -> tuple[int, dict] | None:
    """The last commit: its number and what it says. This is the pointer that readers follow."""
    known = numbers(spark, path)
    return (known[-1], read(spark, path, known[-1])) if known else None


def put(spark: SparkSession, path: str, number: int, said: dict) -> bool:
    """Make a commit, unless one of the number is there already.

    The file is written under another name first, so that no reader meets a half of it. It gets its name by a link on
    a local disk and by a rename that doesn't overwrite elsewhere; of two writers one succeeds.
    """
    fs, where = _files(spark, path)
    text = json.dumps(said, sort_keys=True)
    if fs.getScheme() == "file":
        folder = where.toUri().getPath()
        os.makedirs(folder, exist_ok=True)
        handle, begun = tempfile.mkstemp(prefix=".", dir=folder)
        with os.fdopen(handle, "w") as out:
            out.write(text)
        try:
            os.link(begun, os.path.join(folder, _name(number)))
        except FileExistsError:
            return False
        finally:
            os.unlink(begun)
        return True
    return _renamed(spark, path, number, text)


def _renamed(spark: SparkSession, path: str, number: int, text: str) -> bool:
    """Write under a hidden name and rename without overwriting."""
    fs, where = _files(spark, path)
    fs.mkdirs(where)
    hadoop = spark._jvm.org.apache.hadoop.fs
    begun = hadoop.Path(where, f".{uuid.uuid4().hex}")
    out = fs.create(begun)
    out.write(bytearray(text.encode()))
    out.close()
    context = hadoop.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    how = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
    how[0] = spark._jvm.java.lang.Enum.valueOf(spark._jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename"), "NONE")
    try:
        context.rename(begun, hadoop.Path(where, _name(number)), how)
    except Py4JJavaError as failed:
        fs.delete(begun, False)
        if "FileAlreadyExists" in failed.java_exception.getClass().getName():
            return False
        raise
    return True
