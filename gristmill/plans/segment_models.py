"""Customer segments: SQL-checked parts, and fits whose rows are checked by tests."""

from __future__ import annotations

from pyspark.sql import functions as F

from gristmill.operators import sampling, segments
from gristmill.operators.storage import stored
from gristmill.plans.registry import Register
from gristmill.plans.sqltext import half_up, ratio
from gristmill.session import written
from gristmill.sources import tables

query = Register()

# Centres in scaled units for the checks that need clusters fixed beforehand.
CENTRES = ((1.2, 1.1, 0.2, -0.5), (-1.0, -1.0, 0.0, 1.0), (0.0, 0.1, -0.6, -0.2), (-0.2, -0.4, 1.0, 0.0), (-0.8, -0.8, -0.8, 3.0))


def _features(spark, sf_dir):
    orders = tables.table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("customer_id"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("amount"),
        F.col("o_orderdate").alias("order_date"),
    )
    return segments.customer_features(orders)


def _scaled(spark, sf_dir):
    return segments.scaled(_features(spark, sf_dir))


def _stored_scaled(spark, sf_dir):
    """Scaled features over a table of their own: fits read them many times, the orders are grouped once."""
    return segments.scaled(written(_features(spark, sf_dir), "customer-features"))


def _assigned(spark, sf_dir):
    """Customers with the nearest of the fixed centres."""
    values = _scaled(spark, sf_dir).withColumn(
        "scaled_values", F.array(*segments.as_columns("scaled_features", segments.FEATURES))
    )
    return segments.nearest(values, CENTRES)


FEATURES = f"""
features AS (
  SELECT o_custkey AS customer_id, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_spend,
         count(*) AS purchase_count,
         {ratio('sum(CAST(o_totalprice AS DECIMAL(18,2)))', 'count(o_totalprice)')} AS avg_basket_size,
         CAST((SELECT CAST(max(o_orderdate) AS DATE) FROM orders) - CAST(max(o_orderdate) AS DATE) AS BIGINT)
           AS days_since_last_purchase
  FROM orders GROUP BY 1
)"""

SCALED = f"""{FEATURES},
scaled AS (
  SELECT *, {", ".join(f"({c} - avg({c}) OVER ()) / stddev_samp({c}) OVER () AS scaled_{c}" for c in segments.FEATURES)}
  FROM features
)"""


def _distance(centre) -> str:
    return " + ".join(f"pow(scaled_{c} - ({v}), 2)" for c, v in zip(segments.FEATURES, centre))


ASSIGNED = f"""{SCALED},
distances AS (
  SELECT *, [{", ".join(f"CAST({_distance(centre)} AS DOUBLE)" for centre in CENTRES)}] AS ds FROM scaled
),
assigned AS (
  SELECT *, list_min(ds) AS squared_distance, CAST(list_position(ds, list_min(ds)) - 1 AS INTEGER) AS cluster FROM distances
),
profiles AS (
  SELECT cluster, count(*) AS customers, {half_up('avg(total_spend)')} AS avg_spend,
         {half_up('avg(purchase_count)')} AS avg_purchases, {half_up('avg(avg_basket_size)')} AS avg_basket,
         {half_up('avg(days_since_last_purchase)')} AS avg_recency
  FROM assigned GROUP BY cluster
)"""


@query("customer_features", f"WITH {FEATURES} SELECT * FROM features")
def customer_features(spark, sf_dir):
    return _features(spark, sf_dir)


@query(
    "scaled_features",
    f"""WITH {SCALED} SELECT customer_id, {", ".join(f"{half_up(f'scaled_{c}', 6)} AS {c}" for c in segments.FEATURES)}
        FROM scaled""",
)
def scaled_features(spark, sf_dir):
    columns = segments.as_columns("scaled_features", segments.FEATURES)
    scaled = _scaled(spark, sf_dir).select("customer_id", *columns)
    return scaled.withColumns({c: F.round(c, 6) for c in segments.FEATURES})


@query(
    "fixed_centroid_wssse",
    f"""WITH {ASSIGNED} SELECT cluster, count(*) AS customers, {half_up('sum(squared_distance)', 4)} AS cost
        FROM assigned GROUP BY cluster""",
)
def fixed_centroid_wssse(spark, sf_dir):
    return segments.cost_by_cluster(_assigned(spark, sf_dir)).withColumn("cost", F.round("cost", 4))


@query("cluster_profile", f"WITH {ASSIGNED} SELECT * FROM profiles")
def cluster_profile(spark, sf_dir):
    return segments.profile(_assigned(spark, sf_dir))


@query(
    "personas",
    f"""WITH {ASSIGNED}, thresholds AS (
          SELECT avg(avg_spend) AS mean_spend, median(avg_spend) AS median_spend,
                 avg(avg_purchases) AS mean_purchases, median(avg_purchases) AS median_purchases,
                 avg(avg_recency) AS mean_recency, median(avg_recency) AS median_recency FROM profiles)
        SELECT profiles.*,
          CASE WHEN avg_spend > mean_spend * 1.5 THEN 'High-Value Loyal Customers'
               WHEN avg_purchases > mean_purchases * 1.2 AND avg_spend > median_spend THEN 'Frequent Moderate Spenders'
               WHEN avg_recency > mean_recency * 1.3 THEN 'At-Risk Inactive Customers'
               WHEN avg_recency < median_recency AND avg_purchases < median_purchases THEN 'New / Recent Bargain Buyers'
               ELSE 'Low-Value Occasional Customers' END AS persona
        FROM profiles, thresholds""",
)
def personas(spark, sf_dir):
    return segments.personas(segments.profile(_assigned(spark, sf_dir)))


def _fitted(scaled):
    with stored(scaled.select("scaled_features")) as kept:
        return segments.kmeans(kept)


@query("kmeans_sizes")
def kmeans_sizes(spark, sf_dir):
    """Sizes and profiles of fitted clusters."""
    scaled = _stored_scaled(spark, sf_dir)
    return segments.personas(segments.profile(_fitted(scaled).transform(scaled)))


@query("kmeans_centroids")
def kmeans_centroids(spark, sf_dir):
    scaled = _stored_scaled(spark, sf_dir)
    return segments.centroids(_fitted(scaled), scaled)


def _stacked_rounds() -> str:
    """Far rows first, then the rounds of every number of clusters written out."""
    columns = ", ".join(f"scaled_{c}" for c in segments.FEATURES)
    most, parts = max(segments.ELBOW), []

    def square(a: str, b: str) -> str:
        return " + ".join(f"({a}[{i}] - {b}[{i}]) * ({a}[{i}] - {b}[{i}])" for i in range(1, len(segments.FEATURES) + 1))

    parts.append(f"points AS MATERIALIZED (SELECT row_number() OVER () AS r, [{columns}] AS x FROM scaled)")
    zero = "[" + ", ".join(["0.0"] * len(segments.FEATURES)) + "]"
    parts.append(f"far0 AS MATERIALIZED (SELECT 0 AS c, x FROM points ORDER BY {square('x', zero)} DESC, x LIMIT 1)")
    for k in range(1, most):
        parts.append(f"""far{k} AS MATERIALIZED (SELECT * FROM far{k - 1} UNION ALL (SELECT {k}, x FROM (
            SELECT p.r, any_value(p.x) AS x, min({square('p.x', 'f.x')}) AS d FROM points p, far{k - 1} f GROUP BY p.r)
            ORDER BY d DESC, x LIMIT 1))""")
    for k in segments.ELBOW:
        before = f"(SELECT * FROM far{most - 1} WHERE c < {k})"
        for turn in range(segments.ITERATIONS):
            name = f"k{k}t{turn}"
            parts.append(f"""{name}a AS (SELECT p.r, any_value(p.x) AS x, min(({square('p.x', 'f.x')}, f.c))[2] AS c
                FROM points p, {before} f GROUP BY p.r)""")
            means = ", ".join(f"avg(x[{i}])" for i in range(1, len(segments.FEATURES) + 1))
            parts.append(f"""{name} AS MATERIALIZED (SELECT f.c, coalesce(m.x, f.x) AS x FROM {before} f
                LEFT JOIN (SELECT c, [{means}] AS x FROM {name}a GROUP BY c) m ON f.c = m.c)""")
            before = name
        parts.append(f"""cost{k} AS (SELECT {k} AS k, sum(d) AS cost FROM (
            SELECT p.r, min({square('p.x', 'f.x')}) AS d FROM points p, {before} f GROUP BY p.r))""")
    costs = " UNION ALL ".join(f"SELECT * FROM cost{k}" for k in segments.ELBOW)
    return f"""WITH {SCALED}, {", ".join(parts)}, costs AS MATERIALIZED ({costs}),
        ends AS (SELECT min(k) AS k0, max(k) AS k1, arg_min(cost, k) AS c0, arg_max(cost, k) AS c1 FROM costs),
        gaps AS (SELECT k, cost, 1 - (k - k0) / (k1 - k0) - (cost - c1) / (c0 - c1) AS gap FROM costs, ends)
        SELECT k, {half_up('cost', 4)} AS cost, k = (SELECT arg_max(k, (gap, -k)) FROM gaps) AS chosen FROM gaps"""


@query("elbow", _stacked_rounds())
def elbow(spark, sf_dir):
    return segments.elbow(_stored_scaled(spark, sf_dir)).withColumn("cost", F.round("cost", 4))


@query("bisecting")
def bisecting(spark, sf_dir):
    return segments.method_comparison(_stored_scaled(spark, sf_dir))


@query("partition_effect")
def partition_effect(spark, sf_dir):
    return segments.partition_effect(_stored_scaled(spark, sf_dir))


@query(
    "plot_sample",
    f"""WITH {FEATURES} SELECT * FROM features
        ORDER BY CAST(('0x' || substr(md5(CAST(customer_id AS VARCHAR)), 1, 8)) AS BIGINT), customer_id LIMIT 5000""",
)
def plot_sample(spark, sf_dir):
    """The customers of the plot of the plane: five thousand, or all of a smaller table."""
    return sampling.exactly(_features(spark, sf_dir), "customer_id", 5000)


@query("pca2")
def pca2(spark, sf_dir):
    return segments.plane(_stored_scaled(spark, sf_dir))
