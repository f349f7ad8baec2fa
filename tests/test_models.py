from __future__ import annotations

import numpy as np
import pytest
from conftest import rows
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from gristmill.functions import numbers
from gristmill.operators import classify, sampling, segments

# Cluster profiles of the fixture and the label each must get.
PROFILES = [
    (0, 5044, 3653.90, 47.72, 75.20, 21.20, "Frequent Moderate Spenders"),
    (1, 2942, 2373.51, 21.30, 105.97, 240.26, "At-Risk Inactive Customers"),
    (2, 3921, 8561.66, 69.37, 125.62, 11.61, "High-Value Loyal Customers"),
    (3, 3251, 847.48, 11.32, 68.10, 11.03, "New / Recent Bargain Buyers"),
    (4, 4842, 487.04, 5.83, 64.44, 134.47, "At-Risk Inactive Customers"),
]
PROFILE = "cluster INT, customers INT, avg_spend DOUBLE, avg_purchases DOUBLE, avg_basket DOUBLE, avg_recency DOUBLE"


def test_personas(spark):
    frame = spark.createDataFrame([p[:6] for p in PROFILES], PROFILE)
    assert rows(segments.personas(frame).select("cluster", "persona")) == [(p[0], p[6]) for p in PROFILES]


def test_seeds_draw_independent_samples(spark):
    frame = spark.range(4000)
    one, same, two = (
        {r["id"] for r in sampling.sample(f, "id", 0.4, seed).collect()}
        for f, seed in ((frame, 1), (frame.repartition(7), 1), (frame, 2))
    )
    assert one == same and 0.3 < len(one & two) / len(one) < 0.5
    parts = {tuple(sorted(r["id"] for r in sampling.with_part(frame, "id", {"a": 0.5, "b": 0.5}, seed=s).where("part = 'a'").collect())) for s in (1, 2, 3)}
    assert len(parts) == 3 and all(0.45 < len(p) / 4000 < 0.55 for p in parts)


def test_samples_of_exactly_n_rows(spark):
    frame = spark.range(3000).select("id", F.lit("x").alias("more"))
    one = rows(sampling.exactly(frame, "id", 100, seed=3))
    assert len(one) == 100 == len(set(one))
    assert one == rows(sampling.exactly(frame.repartition(11), "id", 100, seed=3)) != rows(sampling.exactly(frame, "id", 100, seed=4))
    # A smaller sample is part of a larger one, and parts of a table can be sampled first.
    assert set(rows(sampling.exactly(frame, "id", 40, seed=3))) < set(one)
    halves = [sampling.exactly(frame.where(f"id % 2 = {i}"), "id", 100, seed=3) for i in (0, 1)]
    assert rows(sampling.exactly(halves[0].unionByName(halves[1]), "id", 100, seed=3)) == one
    assert sampling.exactly(frame, "id", 9999).count() == 3000 and sampling.exactly(frame.limit(0), "id", 5).count() == 0


@pytest.fixture(scope="module")
def customers(spark):
    """Three clouds of customers far apart."""
    centres = [(100.0, 2, 50.0, 300), (5000.0, 40, 125.0, 5), (1000.0, 12, 80.0, 60)]
    people = [
        (f"c{i}", s + i % 7, p + i % 3, b + i % 5, d + i % 4) for i in range(90) for s, p, b, d in [centres[i % 3]]
    ]
    schema = "customer_id STRING, total_spend DOUBLE, purchase_count INT, avg_basket_size DOUBLE, days_since_last_purchase INT"
    return spark.createDataFrame(people, schema)


def test_features(spark):
    orders = spark.sql(
        """SELECT * FROM VALUES ('a', 10.00BD, DATE'2024-01-01'), ('a', 5.00BD, DATE'2024-01-05'),
           ('b', 7.50BD, DATE'2024-01-11') AS orders(customer_id, amount, order_date)"""
    )
    assert rows(segments.customer_features(orders)) == [("a", 15.0, 2, 7.5, 6), ("b", 7.5, 1, 7.5, 0)]


def test_scaling(customers):
    names = segments.FEATURES
    scaled = segments.scaled(customers).select(*segments.as_columns("scaled_features", names))
    row = scaled.agg(*(F.avg(n).alias(f"m_{n}") for n in names), *(F.stddev_samp(n).alias(f"s_{n}") for n in names)).first()
    assert all(abs(row[f"m_{n}"]) < 1e-9 and abs(row[f"s_{n}"] - 1) < 1e-9 for n in names)


def test_clusters(customers):
    scaled = segments.scaled(customers)
    model = segments.kmeans(scaled, k=3)
    assigned = model.transform(scaled)
    assert sorted(r["customers"] for r in segments.profile(assigned).collect()) == [30, 30, 30]
    centres = segments.centroids(model, scaled)
    assert centres.count() == 3 and centres.columns == ["cluster", *segments.FEATURES]
    # The cost of the fit is the sum of squared distances to the nearest centre.
    values = assigned.drop("cluster").withColumn(
        "scaled_values", F.array(*segments.as_columns("scaled_features", segments.FEATURES))
    )
    nearest = segments.nearest(values, [list(c) for c in model.clusterCenters()])
    cost = segments.cost_by_cluster(nearest).agg(F.sum("cost")).first()[0]
    assert cost == pytest.approx(model.summary.trainingCost)


def test_sweeps(customers):
    scaled = segments.scaled(customers)
    costs = [r["cost"] for r in segments.elbow(scaled, ks=(2, 3)).orderBy("k").collect()]
    assert costs[0] > costs[1] > 0
    assert rows(segments.method_comparison(scaled, k=3).select("method")) == [("bisecting k-means",), ("k-means",)]
    assert [r["partitions"] for r in segments.partition_effect(scaled, 3).collect()] == [2, 4, 8]


def test_bisecting_around_the_origin(spark):
    """Scaled features have their centre at the origin; it must still be parted from its rows."""
    around = [(x * d, y * d) for d in (3.0, 3.5) for x, y in ((1, 0), (-1, 0), (0, 1), (0, -1))]
    frame = spark.createDataFrame([(list(p),) for p in around], "v array<double>")
    frame = frame.select(array_to_vector("v").alias("scaled_features"))
    model = segments.bisecting(frame, k=4)
    assigned = model.transform(frame)
    assert assigned.columns == ["scaled_features", "cluster"]
    found = {}
    for row in assigned.collect():
        found.setdefault(row["cluster"], []).append(row["scaled_features"].toArray())
    assert sorted(found) == [0, 1, 2, 3]
    assert np.array(model.clusterCenters()) == pytest.approx(np.array([np.mean(found[c], axis=0) for c in range(4)]))
    squares = sum(((np.array(rows) - np.mean(rows, axis=0)) ** 2).sum() for rows in found.values())
    assert segments.cost(model, frame) == pytest.approx(squares)


def test_all_numbers_of_clusters_in_one_scan(customers, monkeypatch):
    """Costs are those of the centres, centres are the means of their rows, and the scans are those of one fit."""
    scaled = segments.scaled(customers)
    x = np.array([r[0].toArray() for r in scaled.select("scaled_features").collect()])
    scans, plain = [], segments._added
    monkeypatch.setattr(segments, "_added", lambda *a: scans.append(1) or plain(*a))
    found = segments.stacked_kmeans(scaled, (1, 2, 3, 4))
    assert len(scans) <= segments.ITERATIONS + 1
    for k, (centres, cost) in found.items():
        squares = ((x[:, None, :] - centres[None]) ** 2).sum(axis=2)
        assert len(centres) == k and cost == pytest.approx(squares.min(axis=1).sum())
        for c, centre in enumerate(centres):
            assert centre == pytest.approx(x[squares.argmin(axis=1) == c].mean(axis=0))
    assert found[1][1] > found[2][1] > found[3][1] >= found[4][1]
    monkeypatch.setattr(segments, "FAN", 2)
    again = segments.stacked_kmeans(scaled.repartition(3), (2,), 3)
    assert len(again[2][0]) == 2
    assert segments.stacked_kmeans(scaled.limit(0), (2, 3)).keys() == {2, 3}


def test_knee():
    assert segments.knee([(3, 10.0), (4, 4.0), (5, 3.0), (6, 2.5), (7, 2.0)]) == 4
    assert segments.knee([(3, 1.0), (4, 1.0)]) == 3 and segments.knee([(5, 2.0)]) == 5


def test_squares_within_and_between(customers):
    scaled = segments.scaled(customers)
    row = segments.split_of_squares(segments.kmeans(scaled, k=3).transform(scaled)).first()
    assert (row["rows"], row["clusters"]) == (90, 3)
    assert row["within"] + row["between"] == pytest.approx(4 * 89)


def test_plane(customers):
    scaled = segments.scaled(customers)
    flat = segments.plane(scaled)
    assert flat.count() == 90
    variances = flat.agg(F.variance("pc1"), F.variance("pc2")).first()
    assert variances[0] > variances[1]
    assert segments.plane(scaled, sample_size=30).count() == 30


def test_squared_distance(spark):
    frame = spark.createDataFrame([([0.0, 3.0], [4.0, 0.0])], "a ARRAY<DOUBLE>, b ARRAY<DOUBLE>")
    assert frame.select(numbers.squared_distance(F.col("a"), F.col("b"))).first()[0] == 25.0


def predictions(spark, tp, fp, tn, fn):
    cells = [(True, True)] * tp + [(True, False)] * fp + [(False, False)] * tn + [(False, True)] * fn
    return spark.createDataFrame(cells, "predicted BOOLEAN, actual BOOLEAN")


def test_confusion(spark):
    row = classify.metrics(predictions(spark, 6, 2, 10, 3), F.col("predicted"), F.col("actual")).first()
    assert (row["tp"], row["fp"], row["tn"], row["fn"]) == (6, 2, 10, 3)
    expected = {"accuracy": 16 / 21, "precision": 0.75, "recall": 2 / 3, "f1": 12 / 17}
    assert all(row[name] == pytest.approx(value) for name, value in expected.items())


@pytest.mark.parametrize("slice_scores", [1, 7, 1000])
def test_rank_auc(spark, slice_scores):
    """Against all pairs, with ties, and against the library's evaluator."""
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    draw = np.random.default_rng(slice_scores)
    pairs = [(float(draw.integers(0, 40)) / 8, bool(draw.integers(0, 3) == 0)) for _ in range(300)]
    frame = spark.createDataFrame([*pairs, (None, True), (0.5, None), (float("nan"), True)], "score DOUBLE, actual BOOLEAN")
    found = classify.rank_auc(frame, F.col("score"), F.col("actual"), slice_scores)
    positive, negative = [s for s, a in pairs if a], [s for s, a in pairs if not a]
    plain = sum((p > n) + (p == n) / 2 for p in positive for n in negative) / (len(positive) * len(negative))
    assert found == pytest.approx(plain, rel=1e-15)
    numeric = spark.createDataFrame([(s, float(a)) for s, a in pairs], "rawPrediction DOUBLE, label DOUBLE")
    assert found == pytest.approx(BinaryClassificationEvaluator(numBins=0).evaluate(numeric))


def test_rank_auc_needs_both_classes(spark):
    for actual in (True, False):
        frame = spark.createDataFrame([(1.0, actual), (2.0, actual)], "score DOUBLE, actual BOOLEAN")
        assert classify.rank_auc(frame, F.col("score"), F.col("actual")) is None


def test_all_negative(spark):
    row = classify.metrics(predictions(spark, 0, 0, 5, 2), F.col("predicted"), F.col("actual")).first()
    assert (row["precision"], row["recall"], row["f1"]) == (0.0, 0.0, 0.0)


def test_weighted_f1_agrees_with_the_evaluator(spark):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator

    frame = predictions(spark, 6, 2, 10, 3)
    ours = classify.metrics(frame, F.col("predicted"), F.col("actual")).first()["weighted_f1"]
    numeric = frame.select(F.col("predicted").cast("double").alias("prediction"), F.col("actual").cast("double").alias("label"))
    assert ours == pytest.approx(MulticlassClassificationEvaluator(metricName="f1").evaluate(numeric))


def test_threshold_sweep_agrees_with_single_thresholds(spark):
    scores = [(i / 20, i % 3 == 0) for i in range(21)]
    frame = spark.createDataFrame(scores, "p DOUBLE, actual BOOLEAN")
    sweep = {r["threshold"]: r for r in classify.threshold_sweep(frame, F.col("p"), F.col("actual")).collect()}
    assert sorted(sweep) == [0.3, 0.5, 0.7]
    for threshold, row in sweep.items():
        one = classify.metrics(frame, F.col("p") >= threshold, F.col("actual")).first()
        assert all(row[c] == one[c] for c in ("precision", "recall", "f1", "fp", "fn"))


@pytest.fixture(scope="module")
def messages(spark):
    spam = ["win a free prize now", "claim cash reward today", "free cash click now", "urgent prize waiting claim"]
    ham = ["see you at lunch", "the meeting moved to monday", "call me when home", "notes from class today"]
    texts = [("spam", f"{t} {i}") for i in range(15) for t in spam] + [("ham", f"{t} {i}") for i in range(30) for t in ham]
    frame = spark.createDataFrame([(i, *t) for i, t in enumerate(texts)], "doc_id LONG, label STRING, message_text STRING")
    return classify.with_parts(classify.with_label(frame)).cache()


def test_messages_are_told_apart(spark, messages, tmp_path):
    train, test = classify.part(messages, "train", "validation"), classify.part(messages, "test")
    model = classify.fit_messages(train, classify.SETTINGS[1])
    measured = dict(rows(classify.evaluation(model, test)))
    assert measured["accuracy"] > 0.95 and measured["roc_auc"] > 0.95
    assert measured["tp"] + measured["fp"] + measured["tn"] + measured["fn"] == test.count()
    model.write().overwrite().save(str(tmp_path / "model"))
    loaded = classify.load_model(str(tmp_path / "model"))
    assert rows(loaded.transform(test).select("doc_id", "prediction")) == rows(model.transform(test).select("doc_id", "prediction"))
    shown = classify.prediction_sample(model, test, 5)
    assert shown.columns == ["message_text", "actual_label", "predicted_label", "spam_probability"] and shown.count() == 5
    probabilities = model.transform(test).select(classify.spam_probability().alias("p")).agg(F.min("p"), F.max("p")).first()
    assert 0 <= probabilities[0] <= probabilities[1] <= 1


def test_search_and_comparisons(messages):
    train, test = classify.part(messages, "train"), classify.part(messages, "test")
    search = classify.parameter_search(messages, classify.SETTINGS[:2])
    assert search.count() == 2 and classify.best_setting(search) in classify.SETTINGS
    found = classify.search_settings(messages, classify.SETTINGS[:2])
    held = dict(rows(classify.score_evaluation(classify.with_scores(test, found.model, "label_idx"))))
    assert held["accuracy"] > 0.95 and held["roc_auc"] > 0.95 and found.setting in classify.SETTINGS
    shown = classify.prediction_sample(found.model, test, 5)
    assert shown.columns == ["message_text", "actual_label", "predicted_label", "spam_probability"] and shown.count() == 5
    setting = classify.SETTINGS[0]
    fits = {r["fit"]: r["train_rows"] for r in classify.subsample_fit(train, test, setting).collect()}
    assert 0 < fits["subsample"] < fits["full"] == train.count()
    assert classify.feature_comparison(train, test, setting).count() == 2


def test_bucket_summary(spark, messages):
    from pyspark.ml import Pipeline

    hashed = Pipeline(stages=classify.text_stages(hashed=True)).fit(messages)
    summary = {r["bucket"]: r["messages"] for r in classify.bucket_summary(hashed.transform(messages)).collect()}
    assert len(summary) == classify.HASH_BUCKETS
    prize = hashed.stages[2].indexOf("prize")
    expected = messages.filter(F.col("message_text").contains("prize")).count()
    assert summary[prize] >= expected > 0


def test_sizes_grow(messages):
    sizes = [sampling.sample(messages, "doc_id", share).count() for share in classify.TRAINING_SHARES]
    assert sizes == sorted(sizes) and sizes[-1] == messages.count()


def test_parts_keep_copies_together(spark):
    frame = spark.range(1000).select((F.col("id") % 100).cast("string").alias("message_text"))
    parts = classify.with_parts(frame)
    assert parts.groupBy("message_text").agg(F.countDistinct("part").alias("n")).filter("n > 1").count() == 0
    assert {r["part"] for r in parts.select("part").distinct().collect()} == {"train", "validation", "test"}


def test_term_weights_agree_with_the_fitted_stages(spark):
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import IDF, CountVectorizer, RegexTokenizer
    from pyspark.ml.functions import vector_to_array

    texts = ["A b b c.", "a c; d", "b a", "A d e"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id LONG, text STRING")
    stages = [
        RegexTokenizer(inputCol="text", outputCol="tokens", pattern="\\W+"),
        CountVectorizer(inputCol="tokens", outputCol="counts", minDF=2),
        IDF(inputCol="counts", outputCol="weights"),
    ]
    model = Pipeline(stages=stages).fit(frame)
    terms = model.stages[1].vocabulary
    fitted = {
        (r["doc_id"], terms[i]): w
        for r in model.transform(frame).select("doc_id", "counts", vector_to_array("weights").alias("w")).collect()
        for i, w in enumerate(r["w"])
        if r["counts"][i] > 0
    }
    ours = {(r["doc_id"], r["term"]): r["tf_idf"] for r in classify.term_weights(frame).collect()}
    assert ours.keys() == fitted.keys()
    assert all(ours[k] == pytest.approx(fitted[k]) for k in ours)
