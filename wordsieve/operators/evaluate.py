"""Confusion counts and scores of predictions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _count(prediction: float, label: float) -> Column:
    return F.count_if((F.col("prediction") == prediction) & (F.col("label") == label))


def confusion(predicted: DataFrame) -> DataFrame:
    """Counts of the four outcomes in one pass: tp, tn, fp, fn."""
    return predicted.agg(
        _count(1.0, 1.0).alias("tp"), _count(0.0, 0.0).alias("tn"),
        _count(1.0, 0.0).alias("fp"), _count(0.0, 1.0).alias("fn"),
    )


def metrics(counts: DataFrame) -> DataFrame:
    """Accuracy, precision, recall, F1 and ``score``, which is a quarter of F1; null where nothing was counted."""
    tp, tn, fp, fn = (F.col(c).cast("double") for c in ("tp", "tn", "fp", "fn"))

    def ratio(part: Column, whole: Column) -> Column:
        return F.when(whole != 0, part / whole)

    p, r = F.col("precision"), F.col("recall")
    scored = counts.select(
        ratio(tp + tn, tp + tn + fp + fn).alias("accuracy"), ratio(tp, tp + fp).alias("precision"),
        ratio(tp, tp + fn).alias("recall"),
    )
    return scored.withColumn("f1", ratio(2 * p * r, p + r)).withColumn("score", ratio(p * r / 2, r + p))


def lexicon_recall(predicted: DataFrame) -> DataFrame:
    """How many listed words are recognised: listed, recognised, recall."""
    listed = predicted.where("label = 1.0")
    return listed.agg(
        F.count(F.lit(1)).alias("listed"), F.count_if(F.col("prediction") == F.col("label")).alias("recognised")
    ).withColumn("recall", F.when(F.col("listed") > 0, F.col("recognised") / F.col("listed")))
