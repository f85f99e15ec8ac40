"""Classifiers in versions, of which a running stream takes the newest that fits."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession

from wordsieve.operators import classify
from wordsieve.sources import commits


def publish(spark: SparkSession, path: str, model: PipelineModel) -> int:
    """Save a model and make it the newest version, whose number is returned. It is complete before the pointer moves."""
    saved = f"{path}/models/{uuid.uuid4().hex}"
    classify.save(model, saved)
    while True:
        known = commits.numbers(spark, f"{path}/commits")
        number = (known[-1] if known else 0) + 1
        if commits.put(spark, f"{path}/commits", number, {"model": saved}):
            return number


def check(spark: SparkSession, model: PipelineModel) -> None:
    """Score one word, as a stream would; raises where the parts of a model don't fit each other or give no 0 or 1."""
    row = spark.createDataFrame([(["word"],)], "word array<string>")
    told = classify.predict(model, row).select("prediction").first()[0]
    if told not in (0.0, 1.0):
        raise ValueError(f"a prediction of {told}")


class Newest:
    """The newest version of a model that can be used, looked up at each call, loaded and checked once.

    A version that can't be loaded or doesn't pass ``check`` is noted in ``refused`` with the reason, and the one
    before stays in use. Without any version that can be used a call raises.
    """

    def __init__(self, spark: SparkSession, path: str, check: Callable[[SparkSession, PipelineModel], None] = check):
        self.spark, self.path, self.check = spark, path, check
        self.number, self.model = 0, None
        self.refused: dict[int, str] = {}

    def __call__(self) -> PipelineModel:
        for number in reversed(commits.numbers(self.spark, f"{self.path}/commits")):
            if number <= self.number:
                break
            if number in self.refused:
                continue
            try:
                model = classify.load(commits.read(self.spark, f"{self.path}/commits", number)["model"])
                self.check(self.spark, model)
            except Exception as reason:  # noqa: BLE001 - whatever is wrong with a version, the stream goes on with the one before
                self.refused[number] = str(reason)
                continue
            self.number, self.model = number, model
            break
        if self.model is None:
            raise LookupError(f"no usable model in {self.path}: {self.refused}")
        return self.model
