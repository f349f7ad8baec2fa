"""What must hold for fits whatever they find, counted on the whole result and checked by SQL on the tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.functions import numbers
from gristmill.operators import classify, sampling, segments
from gristmill.plans import message_models, segment_models
from gristmill.plans.message_models import PLACE
from gristmill.operators.storage import stored
from gristmill.plans.registry import Register
from gristmill.plans.sqltext import half_up
from gristmill.session import new_folder, written

query = Register()


def _figures(frame: DataFrame, **figures: Column) -> DataFrame:
    """One aggregate as rows ``(check, value)``."""
    wide = frame.agg(*(figure.cast("long").alias(name) for name, figure in figures.items()))
    return wide.unpivot([], wide.columns, "check", "value")


def _together(*frames: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _sql(**figures: str) -> str:
    return " UNION ALL ".join(f"SELECT '{name}' AS \"check\", CAST(({value}) AS BIGINT) AS value" for name, value in figures.items())


CUSTOMERS = "SELECT count(DISTINCT o_custkey) FROM orders"


@query("kmeans_checks", _sql(clusters="SELECT 5", customers=CUSTOMERS, centres="SELECT 5", cost_agrees="SELECT 1", nearest="SELECT 0"))
def kmeans_checks(spark, sf_dir):
    """All customers are in clusters, each with its nearest centre, and the stated cost is the sum of squared distances."""
    scaled = segment_models._stored_scaled(spark, sf_dir)
    model = segment_models._fitted(scaled)
    values = F.array(*segments.as_columns("scaled_features", segments.FEATURES))
    centres = [[float(v) for v in centre] for centre in model.clusterCenters()]
    assigned = model.transform(scaled).withColumnRenamed("cluster", "given").withColumn("scaled_values", values)
    assigned = segments.nearest(assigned, centres)
    own = F.element_at(F.array(*(F.array(*(F.lit(v) for v in c)) for c in centres)), F.col("given") + 1)
    further = numbers.squared_distance(F.col("scaled_values"), own) > F.col("squared_distance") * (1 + 1e-9) + 1e-9
    cost = F.lit(float(model.summary.trainingCost))
    # The fit states the cost before its last move of the centres, which can only lower it.
    close = F.sum("squared_distance").between(0.9 * cost, (1 + 1e-9) * cost)
    return _together(
        _figures(
            assigned, clusters=F.countDistinct("given"), customers=F.count("customer_id"), cost_agrees=close.cast("int"),
            nearest=F.count_if(further),
        ),
        _figures(segments.centroids(model, scaled), centres=F.count("cluster")),
    )


METHODS = ("k-means", "bisecting k-means")
SQUARES = " + ".join(f"pow(scaled_{c}, 2)" for c in segments.FEATURES)


@query(
    "cluster_cost_checks",
    f"""WITH {segment_models.SCALED} SELECT method, CAST({segments.CLUSTERS} AS BIGINT) AS clusters, count(*) AS customers,
        {half_up(f'sum({SQUARES})', 4)} AS squares, true AS cost_is_within
        FROM scaled, (VALUES {", ".join(f"('{m}')" for m in METHODS)}) AS methods(method) GROUP BY method""",
)
def cluster_cost_checks(spark, sf_dir):
    """Per method: the squares within and between its clusters add up to those of the table.

    The cost belongs to the centres of the model, so it is no less than the squares within.
    """
    scaled = segment_models._stored_scaled(spark, sf_dir)
    found = []
    with stored(scaled.select("scaled_features")) as kept:
        for method, fit in zip(METHODS, (segments.kmeans, segments.bisecting)):
            model = fit(kept)
            split = segments.split_of_squares(model.transform(kept))
            cost = F.lit(segments.cost(model, kept))
            close = F.col("within").between(0.9 * cost, cost * (1 + 1e-9))
            found.append(
                split.select(
                    F.lit(method).alias("method"), "clusters", F.col("rows").alias("customers"),
                    F.round(F.col("within") + F.col("between"), 4).alias("squares"), close.alias("cost_is_within"),
                )
            )
        return spark.createDataFrame([row for f in found for row in f.collect()], found[0].schema)


@query("plane_checks", _sql(customers=CUSTOMERS, uncorrelated="SELECT 1", ordered="SELECT 1", centred="SELECT 1"))
def plane_checks(spark, sf_dir):
    """Principal components of all customers: centred, uncorrelated, the first with the larger variance."""
    plane = segments.plane(segment_models._stored_scaled(spark, sf_dir))
    return _figures(
        plane, customers=F.count("customer_id"), uncorrelated=(F.abs(F.corr("pc1", "pc2")) < 1e-6).cast("int"),
        ordered=(F.var_samp("pc1") >= F.var_samp("pc2")).cast("int"),
        centred=(F.greatest(F.abs(F.avg("pc1")), F.abs(F.avg("pc2"))) < 1e-6).cast("int"),
    )


MESSAGES = f"""SELECT text, CASE WHEN {PLACE.format('text')} < 0.6 THEN 'train' WHEN {PLACE.format('text')} < 0.8
    THEN 'validation' ELSE 'test' END AS part, quality = 0 AS spam, {PLACE.format('CAST(doc_id AS VARCHAR)')} AS place
    FROM documents JOIN labels USING (doc_id) WHERE length(trim(text)) > 0"""


def _message_rows(condition: str) -> str:
    return f"SELECT count(*) FROM ({MESSAGES}) WHERE {condition}"


@query(
    "spam_checks",
    _sql(
        test_rows=_message_rows("part = 'test'"), test_spam=_message_rows("part = 'test' AND spam"),
        rates_in_range="SELECT 6", settings="SELECT 5", thresholds="SELECT 3", recall_falls="SELECT 1",
    ),
)
def spam_checks(spark, sf_dir):
    """The tuned model judges every test message once; recall cannot rise with the threshold."""
    messages = message_models._stored_messages(spark, sf_dir)
    searched = classify.search_settings(messages)
    search, test = searched.table, classify.part(messages, "test")
    scored = written(classify.with_scores(test, searched.model, "label_idx"), "test-scores")
    found = classify.score_evaluation(scored)
    counts = F.col("metric").isin("tp", "fp", "tn", "fn")
    sweep = classify.threshold_sweep(scored, F.col("spam_probability"), F.col("label_idx") == 1.0)
    return _together(
        _figures(
            found, test_rows=F.sum(F.when(counts, F.col("value"))),
            test_spam=F.sum(F.when(F.col("metric").isin("tp", "fn"), F.col("value"))),
        ),
        _figures(
            found.where(~counts).select("value").unionByName(search.select(F.max("weighted_f1").alias("value"))),
            rates_in_range=F.count_if(F.col("value").between(0, 1)),
        ),
        _figures(search, settings=F.countDistinct("setting")),
        _figures(
            sweep, thresholds=F.count("threshold"),
            recall_falls=(F.max_by("recall", "threshold") <= F.min_by("recall", "threshold")).cast("int"),
        ),
    )


@query(
    "training_size_checks",
    _sql(**{f"rows_{share}": _message_rows(f"part <> 'test' AND place < {share / 100}") for share in (20, 40, 60, 80, 100)}),
)
def training_size_checks(spark, sf_dir):
    """Rows that every fit of the size sweep learns from."""
    train, _ = message_models._split(spark, sf_dir)
    parts = [
        _figures(sampling.sample(train, "doc_id", share), **{f"rows_{round(share * 100)}": F.count("doc_id")})
        for share in classify.TRAINING_SHARES
    ]
    return _together(*parts)


@query(
    "model_file_checks",
    _sql(test_rows=_message_rows("part = 'test'"), same="SELECT 1", stages="SELECT 5"),
)
def model_file_checks(spark, sf_dir):
    """A model that was saved and loaded predicts every test message as the one that was fitted."""
    train, test = message_models._split(spark, sf_dir)
    model = classify.fit_messages(train, message_models.SETTING)
    path = new_folder(spark, "model")
    model.write().save(path)
    loaded = classify.load_model(path)
    both = [m.transform(test).select("doc_id", "prediction", classify.spam_probability().alias(name)) for m, name in ((model, "p"), (loaded, "q"))]
    joined = both[0].join(both[1].withColumnRenamed("prediction", "again"), "doc_id")
    agree = F.count_if((F.col("prediction") == F.col("again")) & (F.col("p") == F.col("q"))) == F.count("doc_id")
    return _together(
        _figures(joined, test_rows=F.count("doc_id"), same=agree.cast("int")),
        spark.range(1).select(F.lit("stages").alias("check"), F.lit(len(loaded.stages)).cast("long").alias("value")),
    )


@query(
    "fit_comparison_checks",
    _sql(
        **{f"rows_{share}": _message_rows(f"part <> 'test' AND place < {share / 100}") for share in (20, 40, 60, 80, 100)},
        rows_full=_message_rows("part <> 'test'"), rows_subsample=_message_rows("part <> 'test' AND place < 0.4"), rates="SELECT 28",
    ),
)
def fit_comparison_checks(spark, sf_dir):
    """The rows that the fits of the size sweep and the reduced fit state, and their rates from 0 to 1."""
    train, test = message_models._split(spark, sf_dir)
    fits = classify.size_sweep(train, test, message_models.SETTING).unionByName(
        classify.subsample_fit(train, test, message_models.SETTING)
    )
    fits = written(fits, "fits")
    name = F.concat(F.lit("rows_"), F.regexp_replace("fit", "%", ""))
    within = sum(F.count_if(F.col(c).between(0, 1)) for c in ("accuracy", "precision", "recall", "f1"))
    return fits.select(name.alias("check"), F.col("train_rows").alias("value")).unionByName(_figures(fits, rates=within))
