"""Hashed term frequencies and inverse document frequencies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.feature import IDF, CountVectorizerModel, ElementwiseProduct, HashingTF, IDFModel, SQLTransformer
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wordsieve.functions.hashing import md5_bucket

TERMS, RAW, FEATURES = "word", "rawFeatures", "features"


def tf_stages(spark: SparkSession, buckets: int = 200, hashing: str = "murmur3") -> list[Transformer]:
    """Stages from an array of terms to hashed counts.

    ``murmur3`` is the stock hash. ``md5`` gives buckets any SQL engine can repeat: terms become
    bucket numbers, which are counted against the fixed list of all buckets.
    """
    if hashing == "murmur3":
        return [HashingTF(inputCol=TERMS, outputCol=RAW, numFeatures=buckets)]
    number = f"conv(substring(md5(t), 1, 8), 16, 10) % {buckets}"
    to_buckets = SQLTransformer(
        statement=f"SELECT *, transform({TERMS}, t -> cast(cast({number} AS bigint) AS string)) AS _buckets FROM __THIS__"
    )
    counter = CountVectorizerModel.from_vocabulary([str(i) for i in range(buckets)], "_buckets", RAW)
    drop = SQLTransformer(statement="SELECT * EXCEPT (_buckets) FROM __THIS__")
    return [to_buckets, counter, drop]


def idf_stage() -> IDF:
    return IDF(inputCol=RAW, outputCol=FEATURES)


def refit_idf(model: PipelineModel, scored: DataFrame) -> PipelineModel:
    """The same pipeline with its document frequencies taken from the rows to be scored."""
    stages, rows = [], scored
    for stage in model.stages:
        if isinstance(stage, IDFModel):
            stage = idf_stage().fit(rows)
        stages.append(stage)
        if isinstance(stage, IDFModel):
            return PipelineModel([*stages, *model.stages[len(stages):]])
        rows = stage.transform(rows)
    return model


def with_idf(model: PipelineModel, weights: Sequence[float]) -> PipelineModel:
    """The same pipeline with given weights of the buckets in place of those it was fitted to."""
    stages = [
        ElementwiseProduct(inputCol=RAW, outputCol=FEATURES, scalingVec=Vectors.dense(weights))
        if isinstance(stage, IDFModel) or isinstance(stage, ElementwiseProduct) and stage.getInputCol() == RAW
        else stage
        for stage in model.stages
    ]
    return PipelineModel(stages)


def vector_rows(df: DataFrame, ids: Sequence[str], vector: str = FEATURES) -> DataFrame:
    """The non-zero entries of a vector column as rows: ids, bucket, value."""
    stored_as = F.unwrap_udt(vector)
    entry = lambda i, v: F.struct(i.alias("bucket"), v.alias("value"))
    # A sparse vector lists its entries; it is not spread over all buckets.
    sparse = F.transform(F.arrays_zip(stored_as["indices"].alias("i"), stored_as["values"].alias("v")), lambda e: entry(e["i"], e["v"]))
    dense = F.transform(stored_as["values"], lambda v, i: entry(i, v))
    entries = df.select(*ids, F.explode(F.when(stored_as["type"] == 0, sparse).otherwise(dense)).alias("e"))
    return entries.where("e.value != 0").select(*ids, F.col("e.bucket").cast("bigint").alias("bucket"), F.col("e.value").alias("value"))


def hashed_counts(df: DataFrame, ids: Sequence[str], terms: Column, buckets: int) -> DataFrame:
    """Hashed term frequencies as rows: ids, bucket, tf."""
    exploded = df.select(*ids, F.explode(terms).alias("term"))
    return exploded.groupBy(*ids, md5_bucket(F.col("term"), buckets).alias("bucket")).agg(F.count(F.lit(1)).alias("tf"))
