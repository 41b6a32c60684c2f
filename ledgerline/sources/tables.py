"""Price-shaped views over the driver's parquet tables.

The application works on ``(date, asset, price)``. These views map the
driver tables onto that shape without doing any of the operators' work:

* ``prices``: one row per order - daily prices of 5 "assets" (order
  priorities) with repeated (asset, date) keys; ``row_id`` breaks ties.
* ``ticks``: one row per event - timestamped, skewed values per event type.
* ``holdings``: line items joined to their order, customer and part -
  portfolio = market segment, asset_name = part brand.
* ``dirty_prices``: ``prices`` as raw strings with injected faults (bad
  price text, negative price, bad date, null asset, duplicated rows).
* ``run_log``: events as step timings (category, status, seconds).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(F.col("o_orderdate").cast("date").alias("date"),
                    F.col("o_orderpriority").alias("asset"),
                    F.col("o_totalprice").alias("price"),
                    F.col("o_orderkey").alias("row_id"))


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(F.col("ts").alias("date"),
                    F.col("event_type").alias("asset"),
                    F.col("value").alias("price"),
                    F.col("event_id").alias("row_id"))


def holdings(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity",
                                                 "l_extendedprice")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    j = (li.join(o, li.l_orderkey == o.o_orderkey)
           .join(c, F.col("o_custkey") == c.c_custkey)
           .join(p, F.col("l_partkey") == p.p_partkey))
    return j.select(F.col("o_orderdate").cast("date").alias("date"),
                    F.col("c_mktsegment").alias("portfolio_id"),
                    F.col("p_brand").alias("asset_name"),
                    F.col("l_quantity").alias("quantity"),
                    F.try_divide(F.col("l_extendedprice"), F.col("l_quantity")).alias("price"))


# Fault pattern of the dirty view (fixed, shared with the SQL oracle):
# order key divisible by 97 -> price text 'invalid'; by 89 -> negative price;
# by 83 -> date text 'not-a-date'; by 79 -> null asset; by 73 -> row repeated.
def dirty_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    price_txt = (F.when(k % 97 == 0, F.lit("invalid"))
                  .when(k % 89 == 0, F.concat(F.lit("-"), F.col("o_totalprice").cast("string")))
                  .otherwise(F.col("o_totalprice").cast("string")))
    date_txt = F.when(k % 83 == 0, F.lit("not-a-date")) \
                .otherwise(F.date_format(F.col("o_orderdate"), "yyyy-MM-dd"))
    asset_txt = F.when(k % 79 == 0, F.lit(None).cast("string")).otherwise(F.col("o_orderpriority"))
    base = o.select(date_txt.alias(" Date"), asset_txt.alias("Asset"),
                    price_txt.alias("Price "), k.cast("string").alias("Row ID"))
    dup = base.filter(F.col("Row ID").cast("long") % 73 == 0)
    return base.unionByName(dup)


# Event type -> step kind of the run log (fixed, shared with the SQL oracle).
STEP_KIND = {"signup": "data_pipeline", "error": "model_training", "purchase": "inference",
             "click": "api_request", "view": "dashboard_load"}


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    kind = F.element_at(F.create_map(*[F.lit(x) for kv in STEP_KIND.items() for x in kv]), F.col("event_type"))
    return e.select(F.col("event_id").alias("run_id"), F.col("ts"),
                    F.coalesce(kind, F.col("event_type")).alias("category"),
                    F.when(F.col("event_type") == "error", "failed").otherwise("success").alias("status"),
                    F.col("value").alias("seconds"))


# The same views as SQL CTE bodies for the DuckDB oracle.
SQL_VIEWS = {
    "prices": "SELECT CAST(o_orderdate AS DATE) AS date, o_orderpriority AS asset, "
              "o_totalprice AS price, o_orderkey AS row_id FROM orders",
    "ticks": "SELECT ts AS date, event_type AS asset, value AS price, event_id AS row_id FROM events",
    "holdings": "SELECT CAST(o.o_orderdate AS DATE) AS date, c.c_mktsegment AS portfolio_id, "
                "p.p_brand AS asset_name, l.l_quantity AS quantity, "
                "l.l_extendedprice / NULLIF(l.l_quantity, 0) AS price "
                "FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey "
                "JOIN customer c ON o.o_custkey = c.c_custkey JOIN part p ON l.l_partkey = p.p_partkey",
    "dirty_prices": "WITH b AS (SELECT CASE WHEN o_orderkey % 83 = 0 THEN 'not-a-date' "
                    "ELSE strftime(o_orderdate, '%Y-%m-%d') END AS \" Date\", "
                    "CASE WHEN o_orderkey % 79 = 0 THEN NULL ELSE o_orderpriority END AS \"Asset\", "
                    "CASE WHEN o_orderkey % 97 = 0 THEN 'invalid' WHEN o_orderkey % 89 = 0 "
                    "THEN '-' || CAST(o_totalprice AS VARCHAR) ELSE CAST(o_totalprice AS VARCHAR) END AS \"Price \", "
                    "CAST(o_orderkey AS VARCHAR) AS \"Row ID\" FROM orders) "
                    "SELECT * FROM b UNION ALL SELECT * FROM b WHERE CAST(\"Row ID\" AS BIGINT) % 73 = 0",
    "run_log": "SELECT event_id AS run_id, ts, coalesce(CASE event_type " + " ".join(
        f"WHEN '{k}' THEN '{v}'" for k, v in STEP_KIND.items()) + " END, event_type) AS category, "
               "CASE WHEN event_type = 'error' THEN 'failed' ELSE 'success' END AS status, "
               "value AS seconds FROM events",
}


def sql_with(*names: str) -> str:
    """``WITH`` clause defining the named views for an oracle query."""
    return "WITH " + ", ".join(f"{n} AS ({SQL_VIEWS[n]})" for n in names) + " "
