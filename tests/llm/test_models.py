"""Quality, language and toxicity models: held-out accuracy, their folded scores against plain ones, and odd tables."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import prose, word
from wordsieve.llm import langid, quality, toxicity
from wordsieve.llm.ngrams import WHITE, text_blocks


def junk(rng):
    kind = rng.randrange(3)
    if kind == 0:
        return " ".join([word(rng)] * 40)
    return " ".join(w.upper() + "!!" if kind == 1 else w + "$$$" for w in prose(rng, 40).split())


def labelled(rng, n, make):
    texts = [make(k) for k in range(n)]
    return texts, [k % 2 for k in range(n)]


def auc(score, label):
    pos, neg = [s for s, y in zip(score, label) if y], [s for s, y in zip(score, label) if not y]
    return np.mean([(a > b) + 0.5 * (a == b) for a in pos for b in neg])


def test_quality_tells_junk_and_folds_exactly(rng):
    texts, labels = labelled(rng, 300, lambda k: prose(rng, 40) if k % 2 else junk(rng))
    model = quality.fit(texts[:200], labels[:200], {0: 1.0, 1: 1.0})
    assert auc(model.score(texts[200:]), labels[200:]) > 0.97
    # The mean over all tokens of a text, taken one by one.
    for text in [*texts[200:205], "x", "", "é é é"]:
        total = n = 0
        for block in text_blocks([text], WHITE, False):
            slots, places = quality.tokens(block)
            total, n = model.parts[slots].sum(dtype=float), len(slots)
        assert model.score([text])[0] == pytest.approx(1 / (1 + np.exp(-(total / max(1, n) + model.bias))), abs=1e-5)


def test_scores_do_not_depend_on_the_batch(rng):
    texts, labels = labelled(rng, 60, lambda k: prose(rng, 40) if k % 2 else junk(rng))
    texts += ["", None, prose(rng, 200_000)]
    model, other = quality.fit(texts[:60], labels, {}), toxicity.fit(texts[:60], labels, {})
    for m in (model, other):
        assert np.allclose(m.score(texts), [m.score([t])[0] for t in texts], atol=1e-6)


def toxic_text(rng, toxic):
    words = prose(rng, rng.choice([8, 40, 600])).split()
    if toxic:
        words[rng.randrange(len(words))] = "zork" + word(rng)
    return " ".join(words)


def test_toxicity_finds_one_word_in_a_long_text(rng):
    texts, labels = labelled(rng, 500, lambda k: toxic_text(rng, k % 2))
    model = toxicity.fit(texts[:350], labels[:350], {})
    score = model.score(texts[350:])
    assert auc(score, labels[350:]) > 0.98
    assert np.mean((score >= 0.3) == np.array(labels[350:])) > 0.95


@pytest.mark.parametrize("term", ["muslim", "juden", "musulmans", "judíos"])
def test_counterfactuals_keep_the_score_of_neutral_mentions(rng, term):
    """In these labels toxic texts name one group; without the penalty its name alone raises the score. Marks may stand beside it."""
    texts, labels = [], []
    for k in range(400):
        words = toxic_text(rng, k % 2).split()
        if k % 2 and rng.random() < 0.7 or not k % 2 and rng.random() < 0.02:
            words.insert(rng.randrange(len(words)), rng.choice([term, term.title() + ",", f"({term})", f"{term}."]))
        texts.append(" ".join(words))
        labels.append(k % 2)
    neutral = [prose(rng, 30) for _ in range(40)]
    named = [t.replace(" ", f" {term}, ", 1) for t in neutral]

    def rise(fairness):
        model = toxicity.fit(texts, labels, {}, fairness=fairness)
        assert auc(model.score(texts), labels) > 0.97
        return float(np.mean(model.score(named) - model.score(neutral)))

    # Where the name raises nothing anyway, nothing is left to penalise.
    assert rise(2.0) < max(0.6 * rise(0.0), 0.01)


def test_terms_are_words_of_the_text():
    for own in toxicity.IDENTITY_TERMS:
        for term in own:
            names = toxicity.bag(term)[2]
            assert len(names) == 1 and np.isin(names, toxicity.bag(f"one ({term.capitalize()}), two")[2]).all()


def test_ordinary_words_that_threaten_together(rng):
    """Each word is in texts of both labels; only one after the other are they toxic."""
    texts, labels = [], []
    for k in range(600):
        words = prose(rng, 40).split()
        at = rng.randrange(1, len(words) - 4)
        words[at:at] = ["hurt", "you"] if k % 2 else ["you", "quietly", "hurt"]
        texts.append(" ".join(words))
        labels.append(k % 2)
    model = toxicity.fit(texts[:500], labels[:500], {})
    assert auc(model.score(texts[500:]), labels[500:]) > 0.9


def test_labels_other_than_two_are_left_out(spark, docs, rng):
    texts, labels = labelled(rng, 60, lambda k: toxic_text(rng, k % 2))
    df = docs([(k, t, "s") for k, t in enumerate(texts)])
    marks = spark.createDataFrame([(k, y) for k, y in enumerate(labels)], "doc_id long, label int")
    odd = spark.createDataFrame([(0, 2), (1, -1), (2, None)], "doc_id long, label int")
    for scored in (toxicity.toxicity, quality.quality):
        want = sorted((r.doc_id, r.score) for r in scored(df, marks).collect())
        assert sorted((r.doc_id, r.score) for r in scored(df, marks.unionByName(odd)).collect()) == want


def language_texts(rng, n):
    words = {"en": "the of and thing with ing".split(), "de": "der und ung schön keit ein".split(), "fr": "le la été que oui eau".split()}
    names = [rng.choice(sorted(words)) for _ in range(n)]
    return ["".join(rng.choice(words[name]) + rng.choice([" ", ""]) for _ in range(60)) for name in names], names


def test_languages_and_rejection(rng):
    texts, names = language_texts(rng, 200)
    model = langid.fit(texts[:150], names[:150])
    got, score, far = model.predict([*texts[150:], "привет как дела сегодня вечером", None, ""])
    assert got[:50] == names[150:] and not any(far[:50]) and all(0 <= s <= 1 for s in score)
    assert far[50] and got[51] == got[52] == langid.UNKNOWN and far[51]
    long = " ".join(texts[150:] * 2000)
    assert np.allclose(model.predict([texts[150], long, texts[151]])[1], [model.predict([t])[1][0] for t in (texts[150], long, texts[151])], atol=1e-5)


def test_model_tables(spark, docs, rng):
    texts, labels = labelled(rng, 80, lambda k: prose(rng, 40) if k % 2 else junk(rng))
    rows = [(k, t, "s") for k, t in enumerate(texts)] + [(None, None, None), (200, "", "s"), (200, "", "s"), (201, "!!! 12", "s")]
    df = docs(rows).withColumns({"score": F.lit("old"), "label": F.lit("x"), "u": F.lit(1)})
    marks = spark.createDataFrame([(k, y) for k, y in enumerate(labels)] + [(None, 1), (200, None), (999, 0)], "doc_id long, label int")
    for scored in (quality.quality(df, marks), toxicity.toxicity(df, marks)):
        got = scored.collect()
        assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
        assert "text" not in scored.columns and {r.label for r in got} == {"x"}
    languages = spark.createDataFrame([(k, "en" if y else "de") for k, y in enumerate(labels)], "doc_id long, label string")
    got = langid.languages(df, languages).collect()
    assert len(got) == len(rows) and {r.lang_pred for r in got if r.doc_id in (None, 200, 201)} == {"und"}
    empty = docs([])
    assert quality.quality(empty, marks).collect() == langid.languages(empty, languages).collect() == toxicity.toxicity(empty, marks).collect() == []
    # No labels at all: every text scores alike.
    assert len({r.score for r in quality.quality(df, marks.limit(0)).collect()}) == 1
    assert {r.lang_pred for r in langid.languages(df, languages.limit(0)).collect()} == {"und"}
    assert len({r.score for r in toxicity.toxicity(df, marks.limit(0)).collect()}) == 1


def test_samples_are_bounded_and_repeat(spark, docs, rng):
    from wordsieve.llm.labelled import sample

    rows = [(k, prose(rng, 20), "s") for k in range(600)]
    marks = spark.createDataFrame([(k, int(k % 3 == 0)) for k in range(600)], "doc_id long, label int")
    found, rates = sample(docs(rows), marks, 50)
    assert rates == {0: 50 / 400, 1: 50 / 200} and 20 < (found.label == 0).sum() < 90 and 20 < (found.label == 1).sum() < 90
    again, _ = sample(docs(rows).repartition(5), marks.repartition(2), 50)
    assert found.equals(again)
    few, _ = sample(docs(rows), marks, 50, most_bytes=2000)
    assert 0 < few.text.str.len().sum() < 5000


def test_repeated_ids_and_texts_count_once(spark, docs, rng):
    from wordsieve.llm.labelled import sample

    texts = [prose(rng, 20) for _ in range(40)]
    rows = [(k, t, "s") for k, t in enumerate(texts)] + [(0, texts[0], "s")] * 500
    marks = spark.createDataFrame([(k, k % 2) for k in range(40)] + [(0, 0)] * 300, "doc_id long, label int")
    found, _ = sample(docs(rows), marks, 1000)
    assert len(found) == 40
    # One id with many texts: no more than fits is fetched.
    many = [(0, prose(rng, 20), "s") for _ in range(400)]
    few, rates = sample(docs(many), marks, 1000, most_bytes=9000)
    assert 0 < few.text.str.len().sum() <= 9000 and rates[0] < 1
    assert len(sample(docs(many), marks, 1000, most_rows=50)[0]) <= 50


def test_counts_of_many_short_texts_are_bounded(monkeypatch):
    texts = [f"word {k}" for k in range(3000)]
    sizes = []
    for rows, found in langid.counts(texts):
        sizes.append(len(rows))
        assert found.nbytes <= (langid.BLOCK_ROWS << langid.BITS) * 4
    assert sum(sizes) == 3000
    with monkeypatch.context() as m:
        m.setattr(langid, "BLOCK_ROWS", 10**9)
        whole = {int(r): c for rows, found in langid.counts(texts[:700]) for r, c in zip(rows, found)}
    for rows, found in langid.counts(texts[:700]):
        assert all((whole[int(r)] == c).all() for r, c in zip(rows, found))
