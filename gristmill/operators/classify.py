"""Message classification: text features, logistic regression, evaluation, comparisons."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, Bucketizer, CountVectorizer, HashingTF, RegexTokenizer, StopWordsRemover
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gristmill.functions import numbers, text
from gristmill.operators import ranking, sampling, stacked
from gristmill.operators.storage import stored
from gristmill.session import written

# Sizes of the two feature spaces, least document count of a word, the
# parameter settings tried (regularisation, iterations, elastic net), thresholds,
# training shares, and the share and iterations of the reduced fit.
VOCABULARY = 5000
MIN_DOCUMENTS = 2
HASH_BUCKETS = 4096
SETTINGS = ((0.01, 10, 0.0), (0.01, 20, 0.0), (0.1, 20, 0.0), (0.01, 20, 0.5), (0.01, 20, 1.0))
THRESHOLDS = (0.30, 0.50, 0.70)
TRAINING_SHARES = (0.2, 0.4, 0.6, 0.8, 1.0)
REDUCED_SHARE, REDUCED_ITERATIONS = 0.4, 5
PARTS = {"train": 0.6, "validation": 0.2, "test": 0.2}

Setting = tuple[float, int, float]


def with_label(messages: DataFrame) -> DataFrame:
    """Numeric label: spam is always 1, however frequent it is."""
    return messages.withColumn("label_idx", F.when(F.col("label") == "spam", 1.0).otherwise(0.0))


def with_parts(messages: DataFrame) -> DataFrame:
    """Split by message text, so that copies of one message never sit on both sides."""
    return sampling.with_part(messages, "message_text", PARTS)


def part(messages: DataFrame, *names: str) -> DataFrame:
    return messages.filter(F.col("part").isin(*names))


def text_stages(hashed: bool = False) -> list[Estimator]:
    """Tokens, stop words, term counts (exact or hashed) and inverse document frequency."""
    if hashed:
        counts = HashingTF(inputCol="terms", outputCol="counts", numFeatures=HASH_BUCKETS)
    else:
        counts = CountVectorizer(inputCol="terms", outputCol="counts", vocabSize=VOCABULARY, minDF=MIN_DOCUMENTS)
    return [
        RegexTokenizer(inputCol="message_text", outputCol="tokens", pattern="\\W+", toLowercase=True),
        StopWordsRemover(inputCol="tokens", outputCol="terms"),
        counts,
        IDF(inputCol="counts", outputCol="features"),
    ]


def regression(setting: Setting) -> LogisticRegression:
    penalty, iterations, mix = setting
    return LogisticRegression(
        featuresCol="features", labelCol="label_idx", regParam=penalty, maxIter=iterations, elasticNetParam=mix
    )


def fit_regression(features: DataFrame, setting: Setting) -> Model:
    """Fit over kept features, in the partitions they were kept in."""
    return regression(setting).fit(features)


def fit_messages(train: DataFrame, setting: Setting, hashed: bool = False) -> PipelineModel:
    """A model of all stages from text to prediction, which can be saved and loaded.

    The texts are cut into terms once; vocabulary, document frequencies and the regression, which reads its input in
    every iteration, get kept columns and never the texts.
    """
    cut, weigh = Pipeline(stages=text_stages(hashed)[:2]), text_stages(hashed)[2:]
    words = cut.fit(train)
    with stored(words.transform(train).select("label_idx", "terms")) as terms:
        texts = Pipeline(stages=weigh).fit(terms)
        with stored(texts.transform(terms).select("label_idx", "features")) as features:
            fitted = fit_regression(features, setting)
    return PipelineModel(stages=[*words.stages, *texts.stages, fitted])


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def spam_probability() -> Column:
    return vector_to_array(F.col("probability"))[1]


def confusion(predicted: Column, actual: Column) -> dict[str, Column]:
    """The four counts as aggregates over one pass."""
    return {
        "tp": F.count_if(predicted & actual),
        "fp": F.count_if(predicted & ~actual),
        "tn": F.count_if(~predicted & ~actual),
        "fn": F.count_if(~predicted & actual),
    }


def rates(tp: Column, fp: Column, tn: Column, fn: Column) -> dict[str, Column]:
    """Accuracy, precision, recall and F1; 0 where a divisor is 0."""
    precision, recall = numbers.ratio(tp, tp + fp), numbers.ratio(tp, tp + fn)
    return {
        "accuracy": numbers.ratio(tp + tn, tp + fp + tn + fn),
        "precision": precision,
        "recall": recall,
        "f1": numbers.ratio(2 * precision * recall, precision + recall),
    }


def metrics(predictions: DataFrame, predicted: Column, actual: Column) -> DataFrame:
    """One row: the four counts, the four rates, and F1 of both classes weighted by size."""
    return with_rates(predictions.agg(*(c.alias(n) for n, c in confusion(predicted, actual).items())))


def with_rates(counts: DataFrame) -> DataFrame:
    """The rates beside the four counts of each row."""
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    found = rates(tp, fp, tn, fn)
    both = found["f1"] * (tp + fn) + rates(tn, fn, tp, fp)["f1"] * (tn + fp)
    found["weighted_f1"] = numbers.ratio(both, tp + fp + tn + fn)
    return counts.select("*", *(c.alias(n) for n, c in found.items()))


def threshold_sweep(
    predictions: DataFrame, probability: Column, actual: Column, thresholds: Sequence[float] = THRESHOLDS
) -> DataFrame:
    """Precision, recall and F1 per threshold: all thresholds are counted in one pass."""
    scored = predictions.select(probability.alias("_p"), actual.alias("_actual"))
    counts = scored.agg(
        *(
            F.struct(
                F.lit(float(t)).alias("threshold"),
                *(c.alias(n) for n, c in confusion(F.col("_p") >= t, F.col("_actual")).items()),
            ).alias(f"t{i}")
            for i, t in enumerate(thresholds)
        )
    )
    rows = counts.select(F.inline(F.array(*counts.columns)))
    found = rates(*(F.col(c) for c in ("tp", "fp", "tn", "fn")))
    return rows.select("threshold", *(found[n].alias(n) for n in ("precision", "recall", "f1")), "fp", "fn")


def rank_auc(scored: DataFrame, score: Column, actual: Column, slice_scores: int = 100_000) -> float | None:
    """The exact area under the ROC curve: the share of (positive, negative) pairs in order, ties counting half.

    Positives and negatives are counted per distinct score; the scores are cut along their order into slices of about
    ``slice_scores``, and a score needs only the negatives below it: those of lower slices (one row per slice on the
    driver) and those below it within its slice. No task ranks all scores. None without positives or without
    negatives; rows whose score or class is null or NaN do not count.
    """
    counts = (
        scored.select(score.cast("double").alias("_s"), actual.alias("_a")).dropna()
        .groupBy("_s").agg(F.count_if("_a").alias("pos"), F.count_if(~F.col("_a")).alias("neg"))
    )
    counts = written(counts, "score-counts")
    slices = min(10_000, 1 + counts.count() // slice_scores)
    shares = [i / slices for i in range(1, slices)]
    cuts = set(counts.approxQuantile("_s", shares, 1 / (4 * slices))) if shares else set()
    inner = sorted(cuts - {-math.inf, math.inf})
    sliced = counts.withColumn("_slice", F.lit(0.0))
    if inner:
        splits = [-math.inf, *inner, math.inf]
        sliced = Bucketizer(splits=splits, inputCol="_s", outputCol="_slice").transform(counts)
    below = Window.partitionBy("_slice").orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("neg").over(below), F.lit(0)).cast("decimal(38,0)")
    pairs = sliced.withColumn("_before", before).groupBy("_slice").agg(
        F.sum("pos").alias("pos"), F.sum("neg").alias("neg"),
        F.sum(F.col("pos") * (2 * F.col("_before") + F.col("neg"))).alias("twice"),
    )
    positives = negatives = twice = 0
    for row in pairs.orderBy("_slice").collect():
        twice += int(row["twice"]) + 2 * row["pos"] * negatives
        positives, negatives = positives + row["pos"], negatives + row["neg"]
    return twice / (2 * positives * negatives) if positives and negatives else None


def _outcome(predictions: DataFrame) -> dict[str, float]:
    """The one row of ``metrics`` for a model's predictions."""
    return metrics(predictions, F.col("prediction") == 1.0, F.col("label_idx") == 1.0).first().asDict()


def evaluation(model: Model, frame: DataFrame) -> DataFrame:
    """Rates, ROC-AUC and the four counts as ``(metric, value)`` rows."""
    margin = vector_to_array(F.col("rawPrediction"))[1]
    return score_evaluation(model.transform(frame).select("label_idx", margin.alias("margin")))


def _is_spam() -> Column:
    return F.col("label_idx") == 1.0


def model_metrics(scored: DataFrame) -> list[dict[str, float]]:
    """Counts and rates of every model in ``margins``, counted in one pass."""
    each = scored.select(_is_spam().alias("actual"), F.posexplode("margins").alias("model", "margin"))
    counts = each.groupBy("model").agg(*(c.alias(n) for n, c in confusion(F.col("margin") > 0, F.col("actual")).items()))
    found = {row["model"]: row.asDict() for row in with_rates(counts).collect()}
    none = dict.fromkeys(("tp", "fp", "tn", "fn", "accuracy", "precision", "recall", "f1", "weighted_f1"), 0.0)
    return [found.get(i, none) for i in range(max(found, default=-1) + 1)]


@dataclass
class Search:
    """Settings with what they reach on the validation part, and the best one fitted on all but the test part."""

    table: DataFrame
    setting: Setting
    model: stacked.Linear


def search_settings(messages: DataFrame, settings: Sequence[Setting] = SETTINGS) -> Search:
    """Every setting fitted on the training part and judged on the validation part, best first.

    The same scans fit each setting on training and validation part together too, so the winner needs no fit of its
    own. The test part is left for the winner.
    """
    with stored(stacked.with_terms(messages).select("label_idx", "part", "terms")) as counted:
        sets = {"train": F.col("part") == "train", "known": F.col("part") != "test"}
        fits = [stacked.Fit(rows, setting) for rows in sets for setting in settings]
        models = stacked.stacked_fits(part(counted, "train", "validation"), sets, fits, VOCABULARY, MIN_DOCUMENTS)
        judged = stacked.with_margins(part(counted, "validation"), models[: len(settings)], "label_idx")
        outcomes = model_metrics(judged)
    outcomes += [dict.fromkeys(("accuracy", "weighted_f1"), 0.0)] * (len(settings) - len(outcomes))
    rows = [(i, *s, o["accuracy"], o["weighted_f1"]) for i, (s, o) in enumerate(zip(settings, outcomes), 1)]
    schema = "setting INT, reg_param DOUBLE, max_iter INT, elastic_net DOUBLE, accuracy DOUBLE, weighted_f1 DOUBLE"
    rows.sort(key=lambda row: (-row[5], row[0]))
    best = rows[0][0] - 1
    table = messages.sparkSession.createDataFrame(rows, schema).orderBy(F.desc("weighted_f1"), "setting")
    return Search(table, settings[best], models[len(settings) + best])


def parameter_search(messages: DataFrame, settings: Sequence[Setting] = SETTINGS) -> DataFrame:
    """Accuracy and weighted F1 of each setting on the validation part, best first."""
    return search_settings(messages, settings).table


def tuned_model(messages: DataFrame, settings: Sequence[Setting] = SETTINGS) -> PipelineModel:
    """The best setting of the search as a model that can be saved, fitted on training and validation part."""
    return fit_messages(part(messages, "train", "validation"), search_settings(messages, settings).setting)


def best_setting(search: DataFrame) -> Setting:
    row = search.first()
    return row["reg_param"], row["max_iter"], row["elastic_net"]


def with_scores(messages: DataFrame, model: stacked.Linear, *keep: str) -> DataFrame:
    """The columns ``keep`` with ``margin`` and ``spam_probability`` of a fitted model."""
    scored = stacked.with_margins(stacked.with_terms(messages), [model], *keep)
    margin = F.col("margins").getItem(0)
    return scored.select(*keep, margin.alias("margin"), stacked.probability(margin).alias("spam_probability"))


def score_evaluation(scored: DataFrame) -> DataFrame:
    """Rates, exact ROC-AUC and the four counts as ``(metric, value)`` rows, from ``label_idx`` and ``margin``."""
    with stored(scored.select("label_idx", "margin")) as kept:
        outcome = metrics(kept, F.col("margin") > 0, _is_spam()).first().asDict()
        outcome["roc_auc"] = rank_auc(kept, F.col("margin"), _is_spam())
    names = ("accuracy", "precision", "recall", "f1", "roc_auc", "tp", "fp", "tn", "fn")
    rows = [(name, float(outcome[name] or 0.0)) for name in names]
    return scored.sparkSession.createDataFrame(rows, "metric STRING, value DOUBLE")


FITS = "fit STRING, train_rows LONG, accuracy DOUBLE, precision DOUBLE, recall DOUBLE, f1 DOUBLE"


def fit_comparison(fits: Mapping[str, tuple[DataFrame, Setting, bool]], test: DataFrame) -> DataFrame:
    """Rows trained on and rates on ``test`` per named fit ``(train, setting, hashed)``."""
    rows = []
    for name, (train, setting, hashed) in fits.items():
        outcome = _outcome(fit_messages(train, setting, hashed).transform(test))
        found = (outcome[n] for n in ("accuracy", "precision", "recall", "f1"))
        rows.append((name, train.count(), *found))
    return test.sparkSession.createDataFrame(rows, FITS)


def share_comparison(train: DataFrame, test: DataFrame, fits: Mapping[str, tuple[float, Setting]]) -> DataFrame:
    """Rows trained on and rates on ``test`` per named fit on a share of the training messages, all fitted at once."""
    keyed = train.select("label_idx", "message_text", sampling.place(F.col("doc_id")).alias("place"))
    sets = {str(share): F.col("place") < share for share, _ in fits.values()}
    stacks = [stacked.Fit(str(share), setting) for share, setting in fits.values()]
    with stored(stacked.with_terms(keyed).select("label_idx", "place", "terms")) as counted:
        models = stacked.stacked_fits(counted, sets, stacks, VOCABULARY, MIN_DOCUMENTS)
    outcomes = model_metrics(stacked.with_margins(stacked.with_terms(test), models, "label_idx"))
    rates_of = [tuple(o[n] for n in ("accuracy", "precision", "recall", "f1")) for o in outcomes]
    rates_of += [(0.0,) * 4] * (len(models) - len(rates_of))
    rows = [(name, model.train_rows, *rate) for name, model, rate in zip(fits, models, rates_of)]
    return test.sparkSession.createDataFrame(rows, FITS)


def size_sweep(train: DataFrame, test: DataFrame, setting: Setting) -> DataFrame:
    """The same fit on growing shares of the training messages."""
    return share_comparison(train, test, {f"{share:.0%}": (share, setting) for share in TRAINING_SHARES})


def subsample_fit(train: DataFrame, test: DataFrame, setting: Setting) -> DataFrame:
    """The full fit beside one on a sample with few iterations."""
    reduced = (setting[0], REDUCED_ITERATIONS, setting[2])
    return share_comparison(train, test, {"full": (1.0, setting), "subsample": (REDUCED_SHARE, reduced)})


def feature_comparison(train: DataFrame, test: DataFrame, setting: Setting) -> DataFrame:
    """Exact vocabulary beside hashed features."""
    fits = {
        f"exact counts, {VOCABULARY} terms": (train, setting, False),
        f"hashed counts, {HASH_BUCKETS} buckets": (train, setting, True),
    }
    return fit_comparison(fits, test)


def prediction_sample(model: Model | stacked.Linear, messages: DataFrame, rows: int = 20) -> DataFrame:
    """A few predictions to read: message, actual and predicted label, probability; the least ids.

    The messages are chosen first, so that only those go through the model.
    """
    chosen = messages.orderBy("doc_id").limit(rows)
    if isinstance(model, stacked.Linear):
        scored = with_scores(chosen, model, "message_text", "label")
        spam, chance = F.col("margin") > 0, F.col("spam_probability")
    else:
        scored, spam, chance = model.transform(chosen), F.col("prediction") == 1.0, spam_probability()
    return scored.select(
        "message_text",
        F.col("label").alias("actual_label"),
        F.when(spam, "spam").otherwise("ham").alias("predicted_label"),
        F.round(chance, 4).alias("spam_probability"),
    )


def bucket(term: Column, buckets: int = HASH_BUCKETS) -> Column:
    """The bucket of a term: its digest, which every engine computes alike, modulo the number of buckets."""
    return (F.conv(F.substring(F.md5(term), 1, 8), 16, 10).cast("long") % buckets).cast("int")


def hashed_counts(documents: DataFrame, leave_out: Sequence[str] = (), buckets: int = HASH_BUCKETS) -> DataFrame:
    """Hashed features as expressions: per bucket its messages, occurrences, distinct terms and terms beyond the first.

    Terms are counted inside each row; a bucket that several terms of a row share counts the row once. What is
    shuffled is a row per term, and one per bucket, task and message sum.
    """
    counted = written(
        documents.select("doc_id", F.sort_array(text.tokens(F.col("text"))).alias("_pieces")).select(
            F.filter(text.runs(F.col("_pieces")), lambda t: ~t["term"].isin(*leave_out)).alias("terms")
        ),
        "hashed-terms",
    )
    terms = counted.select(F.inline("terms")).groupBy("term").agg(F.sum("tf").alias("tf"))
    per_bucket = terms.groupBy(bucket(F.col("term"), buckets).alias("bucket")).agg(
        F.sum("tf").cast("long").alias("occurrences"), F.count(F.lit(1)).alias("terms")
    )
    own = F.array_distinct(F.transform("terms", lambda t: bucket(t["term"], buckets)))
    messages = counted.select(F.explode(own).alias("bucket")).groupBy("bucket").agg(F.count(F.lit(1)).alias("messages"))
    joined = per_bucket.join(messages, "bucket")
    return joined.select("bucket", "messages", "occurrences", "terms", (F.col("terms") - 1).alias("collisions"))


def bucket_summary(weighted: DataFrame) -> DataFrame:
    """Per feature: messages that have it, and its largest weight, in one aggregate over the sparse vectors."""
    found = weighted.select(Summarizer.metrics("numNonZeros", "max").summary(F.col("features")).alias("s"))
    arrays = found.select(
        F.arrays_zip(
            vector_to_array(F.col("s.numNonZeros")).alias("messages"),
            vector_to_array(F.col("s.max")).alias("largest_weight"),
        ).alias("s")
    )
    rows = arrays.select(F.posexplode("s").alias("bucket", "s"))
    return rows.select("bucket", F.col("s.messages").cast("long").alias("messages"), "s.largest_weight")


def term_counts(documents: DataFrame, leave_out: Sequence[str] = (), key: str = "doc_id") -> DataFrame:
    """How often each term occurs in each document (row), counted row by row without a shuffle."""
    sorted_pieces = documents.select(key, F.sort_array(text.tokens(F.col("text"))).alias("_pieces"))
    counts = sorted_pieces.select(key, F.inline(text.runs(F.col("_pieces"))))
    return counts.filter(~F.col("term").isin(*leave_out)) if leave_out else counts


def vocabulary(counts: DataFrame, total: Column, size: int = VOCABULARY, least: int = MIN_DOCUMENTS) -> DataFrame:
    """The most frequent terms of at least ``least`` documents, with their weight ``ln((N+1)/(df+1))``."""
    terms = counts.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").cast("long").alias("occurrences"))
    top = ranking.most_frequent(terms.filter(F.col("df") >= least), size, "term", "occurrences")
    return top.withColumn("idf", F.log((total + 1) / (F.col("df") + 1)))


def term_weights(
    documents: DataFrame, leave_out: Sequence[str] = (), size: int = VOCABULARY, least: int = MIN_DOCUMENTS
) -> DataFrame:
    """Term frequency, inverse document frequency and their product per document and term.

    The vocabulary has at most ``size`` rows, so it is broadcast and the term counts,
    where common terms fill a large share of the rows, are not shuffled by term. The counts
    are written once, so the texts are split once.
    """
    counts = written(term_counts(documents, leave_out), "term-counts")
    total = documents.select(F.count(F.lit(1))).scalar()
    terms = vocabulary(counts, total, size, least).select("term", "df", "idf")
    return counts.join(F.broadcast(terms), "term").withColumn("tf_idf", F.col("tf") * F.col("idf"))
