"""Classifiers over hashed features, as pipelines that can be saved, loaded and run on streams."""

from __future__ import annotations

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import MultilayerPerceptronClassifier, NaiveBayes
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import Binarizer, IndexToString, StringIndexer, Word2Vec
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordsieve.operators import features as X

# Sizes and limits of the word classifiers.
NB_BUCKETS = 200
MLP_BUCKETS = 20
MLP_LAYERS = [20, 10, 9, 2]
MLP_BLOCK = 512
MLP_SEED = 1234
MLP_ITERATIONS = 128


def _fit(train: DataFrame, buckets: int, hashing: str, classifier: Estimator) -> PipelineModel:
    stages = [*X.tf_stages(train.sparkSession, buckets, hashing), X.idf_stage(), classifier]
    return Pipeline(stages=stages).fit(train)


def fit_naive_bayes(
    train: DataFrame, buckets: int = NB_BUCKETS, hashing: str = "murmur3", smoothing: float = 1.0
) -> PipelineModel:
    """Terms (``word``: array, ``label``) to TF-IDF to multinomial Naive Bayes."""
    return _fit(train, buckets, hashing, NaiveBayes(featuresCol=X.FEATURES, smoothing=smoothing, modelType="multinomial"))


def fit_bernoulli(
    train: DataFrame, buckets: int = NB_BUCKETS, hashing: str = "murmur3", smoothing: float = 1.0
) -> PipelineModel:
    """Naive Bayes on the presence of buckets."""
    present = Binarizer(inputCol=X.RAW, outputCol=X.FEATURES, threshold=0.0)
    classifier = NaiveBayes(featuresCol=X.FEATURES, smoothing=smoothing, modelType="bernoulli")
    return Pipeline(stages=[*X.tf_stages(train.sparkSession, buckets, hashing), present, classifier]).fit(train)


def fit_perceptron(
    train: DataFrame,
    buckets: int = MLP_BUCKETS,
    hashing: str = "murmur3",
    layers: list[int] | None = None,
    block_size: int = MLP_BLOCK,
    seed: int = MLP_SEED,
    max_iter: int = MLP_ITERATIONS,
    tol: float = 1e-4,
) -> PipelineModel:
    """Terms to TF-IDF to a multilayer perceptron. The first layer has one input per bucket."""
    classifier = MultilayerPerceptronClassifier(
        featuresCol=X.FEATURES, layers=layers or MLP_LAYERS, blockSize=block_size, seed=seed, maxIter=max_iter, tol=tol
    )
    return _fit(train, buckets, hashing, classifier)


def fit_word2vec(
    train: DataFrame, size: int = 1, min_count: int = 1, layers: list[int] | None = None, partitions: int = 1
) -> PipelineModel:
    """Word vectors instead of hashed counts, with the labels indexed before and restored after.

    Words below ``min_count`` are left out of the vocabulary, which the driver holds; training runs in ``partitions`` tasks.
    """
    labels = StringIndexer(inputCol="label", outputCol="indexedLabel", stringOrderType="alphabetAsc").fit(train)
    vectors = Word2Vec(inputCol=X.TERMS, outputCol=X.FEATURES, vectorSize=size, minCount=min_count, numPartitions=partitions, seed=MLP_SEED)
    classifier = MultilayerPerceptronClassifier(
        featuresCol=X.FEATURES, labelCol="indexedLabel", layers=layers or [size, 4, 2], seed=MLP_SEED, maxIter=MLP_ITERATIONS
    )
    back = IndexToString(inputCol="prediction", outputCol="predictedLabel", labels=labels.labels)
    return Pipeline(stages=[labels, vectors, classifier, back]).fit(train)


def predict(model: PipelineModel, rows: DataFrame, refit_idf: bool = False) -> DataFrame:
    """``rows`` with ``prediction``; ``refit_idf`` takes document frequencies from the rows themselves."""
    scored = (X.refit_idf(model, rows) if refit_idf else model).transform(rows)
    return scored.drop(X.RAW, X.FEATURES, "rawPrediction", "probability")


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def accuracy(predicted: DataFrame) -> float:
    return MulticlassClassificationEvaluator(metricName="accuracy").evaluate(predicted)


def one_hot(label: Column, classes: int) -> Column:
    """A label as an array with 1.0 at its place."""
    places = F.sequence(F.lit(0), F.lit(classes - 1))
    return F.transform(places, lambda i: F.when(i == label.cast("int"), 1.0).otherwise(0.0))


def argmax(values: Column) -> Column:
    """The place of the largest value, the first among equals."""
    return (F.array_position(values, F.array_max(values)) - 1).cast("double")
