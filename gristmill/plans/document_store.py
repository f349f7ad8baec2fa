"""Document-store operations over the orders, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from gristmill.operators import documents
from gristmill.plans.registry import Register
from gristmill.sources import tables

query = Register()

DOCUMENTS = """
docs AS (
  SELECT o_orderkey AS _id, o_custkey AS customer, o_orderpriority AS category, o_orderstatus AS status,
         CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS price, CAST(1 AS BIGINT) AS quantity
  FROM orders
)"""

FIELDS = "_id, customer, category, status, price, quantity"


def _documents(spark, sf_dir):
    return tables.order_documents(spark, sf_dir)


def _shown(frame):
    return frame.withColumn("price", F.col("price").cast("double"))


@query(
    "doc_insert",
    f"""WITH {DOCUMENTS} SELECT {FIELDS}, CAST(NULL AS VARCHAR) AS segment FROM docs
        UNION ALL SELECT 1000000000000 + c_custkey, c_custkey, NULL, 'New', NULL, NULL, c_mktsegment FROM customer""",
)
def doc_insert(spark, sf_dir):
    """Add a document per customer; it lacks some fields of the orders and brings one of its own."""
    new = tables.table(spark, sf_dir, "customer").select(
        (F.lit(1000000000000) + F.col("c_custkey")).alias("_id"),
        F.col("c_custkey").alias("customer"),
        F.lit("New").alias("status"),
        F.col("c_mktsegment").alias("segment"),
    )
    return _shown(documents.insert(_documents(spark, sf_dir), new))


@query("doc_find", f"WITH {DOCUMENTS} SELECT _id, category, price FROM docs WHERE price > 20000 AND status IN ('F', 'P')")
def doc_find(spark, sf_dir):
    condition = (F.col("price") > 20000) & F.col("status").isin("F", "P")
    return _shown(documents.find(_documents(spark, sf_dir), condition, fields=("_id", "category", "price")))


@query("doc_find_sorted", f"WITH {DOCUMENTS} SELECT {FIELDS} FROM docs WHERE status = 'F' ORDER BY price DESC, _id LIMIT 25")
def doc_find_sorted(spark, sf_dir):
    found = documents.find(_documents(spark, sf_dir), F.col("status") == "F", sort=[F.desc("price")], limit=25)
    return _shown(found)


@query(
    "doc_set",
    f"""WITH {DOCUMENTS} SELECT * REPLACE (CASE WHEN status = 'P' THEN 'Delivered' ELSE status END AS status),
        CASE WHEN status = 'P' THEN true END AS notified FROM docs""",
)
def doc_set(spark, sf_dir):
    changed = documents.set_fields(
        _documents(spark, sf_dir), F.col("status") == "P", {"status": "Delivered", "notified": True}
    )
    return _shown(changed)


@query(
    "doc_set_one",
    f"""WITH {DOCUMENTS} SELECT * REPLACE (
          CASE WHEN _id = (SELECT min(_id) FROM docs WHERE category = '2-HIGH') THEN 'Delivered' ELSE status END AS status)
        FROM docs""",
)
def doc_set_one(spark, sf_dir):
    changed = documents.set_fields(
        _documents(spark, sf_dir), F.col("category") == "2-HIGH", {"status": "Delivered"}, one=True
    )
    return _shown(changed)


@query(
    "doc_inc",
    f"WITH {DOCUMENTS} SELECT * REPLACE (CASE WHEN price > 300000 THEN quantity + 2 ELSE quantity END AS quantity) FROM docs",
)
def doc_inc(spark, sf_dir):
    return _shown(documents.increment(_documents(spark, sf_dir), F.col("price") > 300000, {"quantity": 2}))


@query("doc_delete", f"WITH {DOCUMENTS} SELECT * FROM docs WHERE status <> 'F'")
def doc_delete(spark, sf_dir):
    return _shown(documents.delete(_documents(spark, sf_dir), F.col("status") == "F"))


@query(
    "doc_delete_one",
    f"WITH {DOCUMENTS} SELECT * FROM docs WHERE _id <> (SELECT min(_id) FROM docs WHERE status = 'F')",
)
def doc_delete_one(spark, sf_dir):
    return _shown(documents.delete(_documents(spark, sf_dir), F.col("status") == "F", one=True))


@query(
    "doc_aggregate",
    """SELECT o_orderpriority AS category, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue,
              CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS avg_price, count(*) AS total_orders,
              CAST(max(o_totalprice) AS DOUBLE) AS max_price, CAST(min(o_totalprice) AS DOUBLE) AS min_price
       FROM orders WHERE o_orderstatus IN ('F', 'O') GROUP BY 1 ORDER BY total_revenue DESC, category LIMIT 4""",
)
def doc_aggregate(spark, sf_dir):
    amount = F.sum(F.col("quantity") * F.col("price")).cast("double")
    return documents.aggregate(
        _documents(spark, sf_dir),
        group=["category"],
        measures={
            "total_revenue": amount,
            "avg_price": F.sum("price").cast("double") / F.count("price"),
            "total_orders": F.count(F.lit(1)),
            "max_price": F.max("price").cast("double"),
            "min_price": F.min("price").cast("double"),
        },
        match=F.col("status").isin("F", "O"),
        sort=[F.desc("total_revenue")],
        limit=4,
    )
