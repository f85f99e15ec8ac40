import math

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from wordsieve.operators import classify, evaluate, features, trainset


def bag(spark, *words):
    return spark.createDataFrame([(i, w) for i, w in enumerate(words)], "i int, word string")


@pytest.mark.parametrize("size", ["broadcast", "shuffled"])
def test_train_set(spark, size, request):
    if size != "inline":
        request.getfixturevalue(size)
    corpus, listed = bag(spark, "a", "b", "b", "c"), bag(spark, "c", "d", "d")
    assert sorted(r.word for r in trainset.subtract(corpus, listed, ["i"]).collect()) == ["a", "b", "b"]
    got = {r.word: r.label for r in trainset.label_words(listed, corpus).collect()}
    assert got == {"c": 1.0, "d": 1.0, "a": 0.0, "b": 0.0}


def test_lines_and_words(spark):
    rows = spark.createDataFrame([(1, "Go on!\n??\r\nA b c"), (2, None)], "d int, t string")
    lines = trainset.corpus_lines(rows, ["d"], F.col("t"), "train").collect()
    assert [(r.line_no, r.line) for r in lines] == [(0, "Go on"), (2, "A b c")]
    words = trainset.corpus_words(rows, ["d"], F.col("t")).collect()
    assert [r.word for r in words] == ["go", "on"]


def test_positive_segments(spark):
    rows = trainset.segment_positives(bag(spark, "红苹果", "无"), bag(spark, "苹果", "红苹果", "果")).collect()
    assert sorted(sorted(r.word) for r in rows) == [["无"], ["果", "红苹果", "苹果"]]
    assert {r.label for r in rows} == {1.0}


def test_splits(spark):
    rows = trainset.hash_split(bag(spark, *[f"w{i}" for i in range(500)]), F.col("word"))
    share = rows.where("part = 'train'").count()
    assert 350 < share < 450
    train, test = trainset.random_split(bag(spark, *"abcdefghij"), seed=3)
    assert train.count() + test.count() == 10


def test_points_and_labels(spark):
    row = trainset.parse_points(spark.createDataFrame([("1,0 2 0.5",)], "l string"), F.col("l")).first()
    assert (row.label, row.features) == (1.0, [0.0, 2.0, 0.5])
    row = spark.range(1).select(
        classify.one_hot(F.lit(2.0), 3).alias("h"), classify.argmax(F.array(F.lit(1.0), F.lit(3.0), F.lit(3.0))).alias("a")
    ).first()
    assert (row.h, row.a) == ([0.0, 0.0, 1.0], 1.0)


SENTENCES = ["Hi I heard about Spark", "I wish Java could use case classes", "Logistic regression models are neat"]


@pytest.mark.parametrize("hashing", ["murmur3", "md5"])
def test_tfidf_of_sentences(spark, hashing):
    from pyspark.ml import Pipeline

    rows = spark.createDataFrame([(i, s.lower().split()) for i, s in enumerate(SENTENCES)], "i int, word array<string>")
    model = Pipeline(stages=[*features.tf_stages(spark, 1 << 14, hashing), features.idf_stage()]).fit(rows)
    got = {(r.i, round(r.value, 6)): 1 for r in features.vector_rows(model.transform(rows), ["i"]).collect()}
    once, twice = round(math.log(4 / 2), 6), round(math.log(4 / 3), 6)
    assert set(got) == {(0, once), (0, twice), (1, once), (1, twice), (2, once)}


def test_refit_uses_the_scored_rows(spark):
    def rows(*words):
        return spark.createDataFrame([([w],) for w in words], "word array<string>")

    from pyspark.ml import Pipeline

    model = Pipeline(stages=[*features.tf_stages(spark, 64), features.idf_stage()]).fit(rows("a", "a", "b"))
    refitted = features.refit_idf(model, rows("a", "c"))
    weight = refitted.transform(rows("a")).select(F.array_max(vector_to_array("features")).alias("v")).first().v
    assert weight == pytest.approx(math.log(3 / 2))


@pytest.fixture(scope="module")
def labelled(spark):
    rows = [([w], 1.0) for w in ["bad", "worse", "worst"] * 40] + [([w], 0.0) for w in ["good", "fine"] * 60]
    return spark.createDataFrame(rows, "word array<string>, label double")


@pytest.mark.parametrize("fit", [classify.fit_naive_bayes, classify.fit_bernoulli, classify.fit_perceptron])
def test_classifiers_learn_and_survive_saving(spark, labelled, fit, tmp_path):
    model = fit(labelled)
    scored = classify.predict(model, labelled)
    assert classify.accuracy(scored) == 1.0
    classify.save(model, str(tmp_path / "m"))
    classify.save(model, str(tmp_path / "m"))
    again = classify.predict(classify.load(str(tmp_path / "m")), labelled)
    assert scored.exceptAll(again).isEmpty()


def test_word2vec_restores_labels(spark, labelled):
    scored = classify.predict(classify.fit_word2vec(labelled, size=4), labelled)
    assert {r.predictedLabel for r in scored.select("predictedLabel").distinct().collect()} <= {"0.0", "1.0"}


def counts_of(spark, tp, tn, fp, fn):
    rows = [(1.0, 1.0)] * tp + [(0.0, 0.0)] * tn + [(1.0, 0.0)] * fp + [(0.0, 1.0)] * fn
    return spark.createDataFrame(rows, "prediction double, label double")


def test_scores(spark):
    predicted = counts_of(spark, 3, 4, 1, 2)
    counts = evaluate.confusion(predicted)
    assert tuple(counts.first()) == (3, 4, 1, 2)
    m = evaluate.metrics(counts).first()
    assert m.accuracy == 0.7 and m.precision == 0.75 and m.recall == 0.6
    assert m.f1 == pytest.approx(2 / 3) and m.score == pytest.approx(m.f1 / 4)
    assert tuple(evaluate.lexicon_recall(predicted).first()) == (5, 3, 0.6)
    none = evaluate.metrics(evaluate.confusion(counts_of(spark, 0, 2, 0, 1))).first()
    assert none.precision is None and none.recall == 0.0 and none.f1 is None
