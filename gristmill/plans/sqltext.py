"""Pieces of SQL shared by the checks."""

from __future__ import annotations

SALES = """
sales AS (
  SELECT l_orderkey AS order_id, l_linenumber AS line_number, l_partkey AS part_id, l_suppkey AS supplier_id,
         l_returnflag AS return_flag, l_linestatus AS line_status,
         CAST(o_orderdate AS DATE) AS order_date, CAST(l_shipdate AS DATE) AS ship_date,
         o_custkey AS customer_id, c_name AS customer_name, c_mktsegment AS segment,
         n_name AS state, r_name AS region, p_type AS category, p_brand AS sub_category, p_name AS product,
         CAST(l_quantity AS BIGINT) AS quantity, l_discount AS discount,
         CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(18,4)) AS sales,
         CAST(CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(18,4))
              - CAST(l_quantity AS BIGINT) * CAST(p_retailprice AS DECIMAL(12,2)) AS DECIMAL(18,4)) AS profit
  FROM lineitem
  LEFT JOIN orders ON l_orderkey = o_orderkey
  LEFT JOIN customer ON o_custkey = c_custkey
  LEFT JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN region ON n_regionkey = r_regionkey
  LEFT JOIN part ON l_partkey = p_partkey
)"""

FEED = SALES + """,
feed AS (
  SELECT order_id, line_number, part_id, supplier_id, customer_id, return_flag, line_status,
         CASE WHEN return_flag = 'N' AND line_number = 7 THEN NULL
              ELSE strftime(order_date, '%Y-%m-%d') END AS order_date,
         CASE WHEN line_status = 'O' AND return_flag = 'A' AND line_number = 6 THEN 'pending'
              ELSE strftime(ship_date, '%Y-%m-%d') END AS ship_date,
         CASE WHEN return_flag = 'R' AND line_number = 5 THEN 0 ELSE sales END AS sales,
         CASE WHEN return_flag = 'R' AND line_number = 4 THEN -quantity ELSE quantity END AS quantity,
         CASE WHEN return_flag = 'R' AND line_number = 3 THEN 1.5
              WHEN return_flag = 'R' AND line_number = 2 THEN -0.5 ELSE discount END AS discount,
         profit
  FROM sales
  CROSS JOIN generate_series(1, 2) AS copies(copy)
  WHERE copy = 1 OR (line_status = 'F' AND return_flag = 'A' AND line_number = 1)
)"""

WORD_POSTS = r"""
posts AS (
  SELECT region, platform, hashtag FROM (
    SELECT lang AS region, source AS platform, unnest(regexp_split_to_array(text, '\W+')) AS hashtag FROM documents
  ) WHERE hashtag <> ''
),
tagged AS (SELECT region, platform, hashtag AS raw, '#' || upper(hashtag) AS hashtag FROM posts)"""


def double(expression: str) -> str:
    return f"CAST({expression} AS DOUBLE)"


def ratio(part: str, whole: str) -> str:
    return f"COALESCE({double(part)} / NULLIF({double(whole)}, 0), 0.0)"


def percent(part: str, whole: str, digits: int = 2) -> str:
    return f"round_even({ratio(part, whole)} * 100, {digits})"


def half_up(expression: str, digits: int = 2) -> str:
    """Rounding of the shortest decimal form of a double, half away from zero."""
    return double(f"round(CAST(CAST({expression} AS VARCHAR) AS DECIMAL(38,16)), {digits})")


def long(expression: str) -> str:
    return f"CAST({expression} AS BIGINT)"
