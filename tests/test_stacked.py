"""Fits of several settings and row sets at once, against the same fits alone and against the library's own."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from gristmill.operators import stacked
from gristmill.operators.stacked import Fit

SIZE, LEAST = 60, 2
CONDITIONS = {"most": "doc_id % 5 <> 0", "half": "doc_id % 2 = 0", "all": "true"}
FITS = [
    Fit("most", (0.01, 10, 0.0)), Fit("most", (0.1, 20, 0.0)), Fit("most", (0.01, 20, 0.5)),
    Fit("half", (0.01, 20, 1.0)), Fit("all", (0.05, 20, 0.0)), Fit("half", (0.02, 3, 0.0)),
]


def sets(*names):
    return {name: F.expr(CONDITIONS[name]) for name in names or CONDITIONS}


@pytest.fixture(scope="module")
def messages(spark):
    draw = np.random.default_rng(3)
    words = [f"word{i}" for i in range(80)] + ["the", "and"]
    lean = draw.normal(size=82)
    rows = []
    for i in range(400):
        picked = draw.integers(0, 82, draw.integers(0, 30))
        spam = lean[picked].sum() + draw.normal() > 0
        rows.append((i, float(spam), " ".join(words[j] for j in picked) + ("." if i % 3 else " WORD1")))
    rows.append((400, 1.0, None))
    frame = spark.createDataFrame(rows, "doc_id LONG, label_idx DOUBLE, message_text STRING")
    return stacked.with_terms(frame).cache()


def test_together_as_alone(messages):
    together = stacked.stacked_fits(messages, sets(), FITS, SIZE, LEAST)
    for fit, model in list(zip(FITS, together))[::2]:
        (alone,) = stacked.stacked_fits(messages, sets(fit.rows), [fit], SIZE, LEAST)
        mine = {t: w for t, w in zip(model.terms, model.coefficients) if w}
        own = {t: w for t, w in zip(alone.terms, alone.coefficients) if w}
        assert mine.keys() == own.keys() and mine
        assert all(abs(mine[t] - own[t]) < 1e-6 for t in own)
        assert abs(model.intercept - alone.intercept) < 1e-6 and model.train_rows == alone.train_rows


@pytest.mark.parametrize("penalty, mix", [(0.1, 0.0), (0.02, 0.5)])
def test_agrees_with_the_library(messages, penalty, mix):
    """Both run to the minimum: the same coefficients."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import IDF, CountVectorizer, RegexTokenizer, StopWordsRemover

    (model,) = stacked.stacked_fits(messages, sets("all"), [Fit("all", (penalty, 300, mix))], 1000, LEAST, 1e-13)
    rows = messages.where("message_text IS NOT NULL").unionByName(
        messages.where("message_text IS NULL").withColumn("message_text", F.lit(""))
    )
    stages = [
        RegexTokenizer(inputCol="message_text", outputCol="tokens", pattern="\\W+"),
        StopWordsRemover(inputCol="tokens", outputCol="kept"),
        CountVectorizer(inputCol="kept", outputCol="counts", vocabSize=1000, minDF=LEAST),
        IDF(inputCol="counts", outputCol="features"),
        LogisticRegression(labelCol="label_idx", regParam=penalty, elasticNetParam=mix, maxIter=300, tol=1e-13),
    ]
    fitted = Pipeline(stages=stages).fit(rows)
    mine = dict(zip(model.terms, model.coefficients))
    assert mine.keys() == set(fitted.stages[2].vocabulary)
    for term, weight in zip(fitted.stages[2].vocabulary, fitted.stages[4].coefficients):
        assert mine[term] == pytest.approx(weight, abs=2e-5)
    assert model.intercept == pytest.approx(fitted.stages[4].intercept, abs=2e-5)


def test_scores_of_all_models(messages):
    models = stacked.stacked_fits(messages, sets(), FITS, SIZE, LEAST)
    found = {r["doc_id"]: r["margins"] for r in stacked.with_margins(messages, models, "doc_id").collect()}
    for row in messages.select("doc_id", "terms").collect():
        counts = {t["term"]: t["tf"] for t in row["terms"] or []}
        for model, margin in zip(models, found[row["doc_id"]]):
            plain = model.intercept + sum(w * counts.get(t, 0) for t, w in zip(model.terms, model.weights))
            assert margin == pytest.approx(plain, abs=1e-9)


def test_few_scans(messages, monkeypatch):
    """All fits share their scans: as many as the longest fit takes, not the sum over the fits."""
    calls, plain = [], stacked._sums

    def sums(*arguments):
        calls.append(len(arguments[2]))
        return plain(*arguments)

    monkeypatch.setattr(stacked, "_sums", sums)
    stacked.stacked_fits(messages, sets(), FITS, SIZE, LEAST)
    assert len(calls) < sum(calls) / 2 and calls[0] == len(FITS)


def test_sums_of_many_tasks_are_added_in_a_tree(messages, monkeypatch):
    (plain,) = stacked.stacked_fits(messages, sets("all"), [Fit("all", (0.1, 4, 0.0))], SIZE, LEAST)
    monkeypatch.setattr(stacked, "FAN", 2)
    (tree,) = stacked.stacked_fits(messages.repartition(5), sets("all"), [Fit("all", (0.1, 4, 0.0))], SIZE, LEAST)
    assert np.abs(plain.weights - tree.weights).max() < 1e-9


def test_no_rows(messages):
    (model,) = stacked.stacked_fits(messages.limit(0), sets("all"), [Fit("all", (0.1, 5, 0.0))], SIZE, LEAST)
    assert model.terms == [] and model.train_rows == 0
