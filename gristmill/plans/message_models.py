"""Message classification: SQL-checked parts, and fits whose rows are checked by tests."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from gristmill.operators import classify, quality, sampling
from gristmill.operators.wordcount import COMMON_WORDS
from gristmill.plans.registry import Register
from gristmill.plans.sqltext import half_up, ratio
from gristmill.session import written
from gristmill.sources import tables

query = Register()

# The setting of the comparisons, which vary something else.
SETTING = classify.SETTINGS[1]


def _messages(spark, sf_dir):
    cleaned = quality.clean_messages(tables.messages(spark, sf_dir))
    return classify.with_parts(classify.with_label(cleaned))


def _stored_messages(spark, sf_dir):
    """The messages as a table of their own: fits read them several times, the join runs once."""
    return written(_messages(spark, sf_dir), "messages")


def _split(spark, sf_dir):
    messages = _stored_messages(spark, sf_dir)
    return classify.part(messages, "train", "validation"), classify.part(messages, "test")


TERMS = r"""
terms AS (
  SELECT doc_id, term, count(*) AS tf FROM (
    SELECT doc_id, unnest(regexp_split_to_array(lower(text), '\W+')) AS term FROM documents)
  WHERE term <> '' AND term NOT IN ('the', 'is', 'and', 'of') GROUP BY 1, 2
),
vocabulary AS (
  SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS occurrences,
         ln(((SELECT count(*) FROM documents) + 1) / (count(*) + 1)) AS idf
  FROM terms GROUP BY 1 HAVING count(*) >= 2 ORDER BY occurrences DESC, term LIMIT 5000
)"""


@query(
    "tfidf_terms",
    f"""WITH {TERMS} SELECT doc_id, term, tf, df, {half_up('idf', 8)} AS idf, {half_up('tf * idf', 8)} AS tf_idf
        FROM terms JOIN vocabulary USING (term)""",
)
def tfidf_terms(spark, sf_dir):
    weights = classify.term_weights(tables.documents(spark, sf_dir, "doc_id", "text"), COMMON_WORDS)
    return weights.withColumns({c: F.round(c, 8) for c in ("idf", "tf_idf")})


@query("tfidf_vocabulary", f"WITH {TERMS} SELECT term, df, occurrences, {half_up('idf', 8)} AS idf FROM vocabulary")
def tfidf_vocabulary(spark, sf_dir):
    documents = tables.documents(spark, sf_dir, "doc_id", "text")
    total = documents.select(F.count(F.lit(1))).scalar()
    terms = classify.vocabulary(classify.term_counts(documents, COMMON_WORDS), total)
    return terms.withColumn("idf", F.round("idf", 8))


PLACE = "(CAST(('0x' || substr(md5({}), 1, 8)) AS BIGINT) / 4294967296.0)"


@query(
    "message_parts",
    f"""SELECT doc_id, CASE WHEN quality = 0 THEN 'spam' ELSE 'ham' END AS label,
               CASE WHEN {PLACE.format('text')} < 0.6 THEN 'train' WHEN {PLACE.format('text')} < 0.8 THEN 'validation'
                    ELSE 'test' END AS part
        FROM documents JOIN labels USING (doc_id) WHERE length(trim(text)) > 0""",
)
def message_parts(spark, sf_dir):
    return _messages(spark, sf_dir).select("doc_id", "label", "part")


@query("sample_documents", f"SELECT doc_id, lang, source FROM documents WHERE {PLACE.format('CAST(doc_id AS VARCHAR)')} < 0.4")
def sample_documents(spark, sf_dir):
    return sampling.sample(tables.table(spark, sf_dir, "documents").select("doc_id", "lang", "source"), "doc_id", 0.4)


SEEDED = "(CAST(('0x' || substr(md5('42:' || {}), 1, 8)) AS BIGINT) / 4294967296.0)"


@query("seeded_sample", f"SELECT doc_id, lang, source FROM documents WHERE {SEEDED.format('CAST(doc_id AS VARCHAR)')} < 0.4")
def seeded_sample(spark, sf_dir):
    documents = tables.table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    return sampling.sample(documents, "doc_id", 0.4, seed=42)


@query(
    "seeded_parts",
    f"""SELECT o_orderkey, CASE WHEN {SEEDED.format('CAST(o_orderkey AS VARCHAR)')} < 0.8 THEN 'train' ELSE 'test' END AS part
        FROM orders""",
)
def seeded_parts(spark, sf_dir):
    orders = tables.table(spark, sf_dir, "orders").select("o_orderkey")
    return sampling.with_part(orders, "o_orderkey", {"train": 0.8, "test": 0.2}, seed=42)


# A fixed rule scores each message by its length, so that the checks need no fit.
SCORED = """
scored AS (
  SELECT quality = 0 AS actual, 400.0 / (400.0 + length(text)) AS probability
  FROM documents JOIN labels USING (doc_id) WHERE length(trim(text)) > 0
)"""


def _scored(spark, sf_dir):
    probability = F.lit(400.0) / (F.lit(400.0) + F.length("message_text"))
    return _messages(spark, sf_dir).select((F.col("label_idx") == 1.0).alias("actual"), probability.alias("probability"))


def _rates() -> str:
    return f"""
rated AS (
  SELECT *, {ratio('tp + tn', 'tp + fp + tn + fn')} AS accuracy, {ratio('tp', 'tp + fp')} AS precision,
         {ratio('tp', 'tp + fn')} AS recall, {ratio('tn', 'tn + fn')} AS other_precision, {ratio('tn', 'tn + fp')} AS other_recall
  FROM counted
),
final AS (
  SELECT *, {ratio('2 * precision * recall', 'precision + recall')} AS f1,
         {ratio('2 * other_precision * other_recall', 'other_precision + other_recall')} AS other_f1
  FROM rated
)"""


def _counted(threshold: str) -> str:
    return f"""count(*) FILTER (WHERE probability >= {threshold} AND actual) AS tp,
         count(*) FILTER (WHERE probability >= {threshold} AND NOT actual) AS fp,
         count(*) FILTER (WHERE probability < {threshold} AND NOT actual) AS tn,
         count(*) FILTER (WHERE probability < {threshold} AND actual) AS fn"""


@query(
    "confusion",
    f"""WITH {SCORED}, counted AS (SELECT {_counted('0.5')} FROM scored), {_rates()}
        SELECT tp, fp, tn, fn, accuracy, precision, recall, f1,
               {ratio('f1 * (tp + fn) + other_f1 * (tn + fp)', 'tp + fp + tn + fn')} AS weighted_f1 FROM final""",
)
def confusion(spark, sf_dir):
    return classify.metrics(_scored(spark, sf_dir), F.col("probability") >= 0.5, F.col("actual"))


@query(
    "threshold_sweep",
    f"""WITH {SCORED}, thresholds(threshold) AS (VALUES (CAST(0.3 AS DOUBLE)), (CAST(0.5 AS DOUBLE)), (CAST(0.7 AS DOUBLE))),
        counted AS (SELECT threshold, {_counted('threshold')} FROM scored, thresholds GROUP BY threshold), {_rates()}
        SELECT threshold, precision, recall, f1, fp, fn FROM final""",
)
def threshold_sweep(spark, sf_dir):
    return classify.threshold_sweep(_scored(spark, sf_dir), F.col("probability"), F.col("actual"))


@query("hashing_tf")
def hashing_tf(spark, sf_dir):
    """Messages and largest weight of each bucket of the hashed features."""
    messages = _stored_messages(spark, sf_dir)
    features = Pipeline(stages=classify.text_stages(hashed=True)).fit(messages)
    return classify.bucket_summary(features.transform(messages))


@query(
    "hashed_counts",
    r"""WITH words AS (
          SELECT doc_id, unnest(regexp_split_to_array(lower(text), '\W+')) AS term FROM documents),
        hashed AS (SELECT doc_id, term, CAST(CAST(('0x' || substr(md5(term), 1, 8)) AS BIGINT) % 4096 AS INTEGER) AS bucket
          FROM words WHERE term <> '' AND term NOT IN ('the', 'is', 'and', 'of'))
        SELECT bucket, count(DISTINCT doc_id) AS messages, count(*) AS occurrences, count(DISTINCT term) AS terms,
               count(DISTINCT term) - 1 AS collisions FROM hashed GROUP BY bucket""",
)
def hashed_counts(spark, sf_dir):
    return classify.hashed_counts(tables.documents(spark, sf_dir, "doc_id", "text"), COMMON_WORDS)


@query(
    "exact_sample",
    f"""SELECT doc_id, lang, source FROM documents ORDER BY {SEEDED.format('CAST(doc_id AS VARCHAR)')}, doc_id LIMIT 10000""",
)
def exact_sample(spark, sf_dir):
    """Ten thousand documents to fit on, the same on any layout."""
    documents = tables.table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    return sampling.exactly(documents, "doc_id", 10_000, seed=42)


@query("spam_predictions")
def spam_predictions(spark, sf_dir):
    """Twenty predictions of the tuned model to read."""
    messages = _stored_messages(spark, sf_dir)
    return classify.prediction_sample(classify.search_settings(messages).model, classify.part(messages, "test"))


@query("spam_evaluation")
def spam_evaluation(spark, sf_dir):
    """The tuned model on the test part, which no choice has seen."""
    messages = _stored_messages(spark, sf_dir)
    model = classify.search_settings(messages).model
    return classify.score_evaluation(classify.with_scores(classify.part(messages, "test"), model, "label_idx"))


@query("spam_thresholds")
def spam_thresholds(spark, sf_dir):
    """Rates of the tuned model on the test part at several thresholds."""
    messages = _stored_messages(spark, sf_dir)
    model = classify.search_settings(messages).model
    scored = classify.with_scores(classify.part(messages, "test"), model, "label_idx")
    return classify.threshold_sweep(scored, F.col("spam_probability"), F.col("label_idx") == 1.0)


AUC = f"""WITH {SCORED},
scores AS (SELECT probability, count(*) FILTER (WHERE actual) AS pos, count(*) FILTER (WHERE NOT actual) AS neg
           FROM scored GROUP BY 1),
placed AS (SELECT pos, neg, coalesce(sum(neg) OVER (ORDER BY probability ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
             AS below FROM scores)
SELECT CAST(sum(pos) AS BIGINT) AS positives, CAST(sum(neg) AS BIGINT) AS negatives,
       CAST(sum(pos * (2 * below + neg)) AS DOUBLE) / CAST(2 * sum(pos) * sum(neg) AS DOUBLE) AS roc_auc FROM placed"""


@query("rank_auc", AUC)
def rank_auc(spark, sf_dir):
    """The exact area under the ROC curve of the fixed rule, with the numbers of both classes."""
    scored = written(_scored(spark, sf_dir), "scored-messages")
    area = classify.rank_auc(scored, F.col("probability"), F.col("actual"))
    counts = scored.agg(F.count_if("actual").alias("positives"), F.count_if(~F.col("actual")).alias("negatives"))
    return counts.withColumn("roc_auc", F.lit(area).cast("double"))


@query("grid_search")
def grid_search(spark, sf_dir):
    return classify.parameter_search(_stored_messages(spark, sf_dir))


@query("size_sweep")
def size_sweep(spark, sf_dir):
    return classify.size_sweep(*_split(spark, sf_dir), SETTING)


@query("subsample_fit")
def subsample_fit(spark, sf_dir):
    return classify.subsample_fit(*_split(spark, sf_dir), SETTING)


@query("feature_comparison")
def feature_comparison(spark, sf_dir):
    return classify.feature_comparison(*_split(spark, sf_dir), SETTING)
