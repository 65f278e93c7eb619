"""Map the TPC-H-like driver tables onto the three silver domain shapes.

The driver data has orders, lineitem and events rather than cost ledgers,
production logs and meter readings; these views give them the silver schema
(see SURVEY 7.3).  Every mapping is a projection plus one equi-join, so the
work grows with the tables and Catalyst prunes the scan to the used columns.
Joins carry no broadcast hint: adaptive execution broadcasts the dimension
side only when its measured size is under the threshold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plantwise.session import table_path

# Amounts (money, metered energy) are fixed-point: sums are exact and do not
# depend on summation order, so every engine and every plan agrees on them.
MONEY = "decimal(15,2)"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def silver_costs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders x customer -> monthly cost ledger lines."""
    o = read_table(spark, sf_dir, "orders")
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    j = o.join(c, o.o_custkey == c.c_custkey)
    fx = 1 + (F.col("o_orderkey") % 10).cast("double") / 100
    ref_month = F.date_trunc("month", F.col("o_orderdate"))
    return j.select(
        ref_month.alias("ref_month"),
        F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("site_code"),
        F.col("o_orderpriority").alias("cost_center"),
        F.col("o_orderstatus").alias("account_code"),
        F.concat(F.lit("status "), F.col("o_orderstatus")).alias("account_name"),
        F.col("o_totalprice").cast(MONEY).alias("amount_br"),
        (F.col("o_totalprice") * (1 - (F.col("o_orderkey") % 7).cast("double") / 100) / fx)
        .alias("amount_fx"),
        fx.alias("fx_rate"),
        ref_month.alias("dt"),
    )


def _lineitem_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    s = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    return li.join(s, li.l_suppkey == s.s_suppkey)


def silver_manufacturing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem x supplier -> production records (one per shipped line)."""
    j = _lineitem_supplier(spark, sf_dir)
    return j.select(
        F.col("l_shipdate").alias("date"),
        F.concat(F.lit("N"), F.col("s_nationkey").cast("string")).alias("site_code"),
        F.concat(F.lit("L"), F.col("l_suppkey").cast("string")).alias("line_code"),
        F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("product_code"),
        F.col("l_quantity").cast("long").alias("units_ok"),
        (F.col("l_quantity") * F.col("l_discount")).cast("long").alias("units_rework"),
        (F.col("l_quantity") * F.col("l_tax")).cast("long").alias("scrap_units"),
        F.try_divide(F.col("l_extendedprice"), F.col("l_quantity")).alias("takt_time_s"),
        (1 - F.col("l_discount")).alias("oee"),
        F.date_trunc("day", F.col("l_shipdate")).alias("dt"),
    )


def silver_energy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem x supplier -> meter readings on the production calendar."""
    j = _lineitem_supplier(spark, sf_dir)
    return j.select(
        F.col("l_shipdate").alias("timestamp"),
        F.concat(F.lit("N"), F.col("s_nationkey").cast("string")).alias("site_code"),
        F.concat(F.lit("L"), F.col("l_suppkey").cast("string")).alias("line_code"),
        F.concat(F.lit("E"), F.col("l_linenumber").cast("string")).alias("equip_code"),
        F.col("l_extendedprice").cast(MONEY).alias("kwh"),
        F.col("l_quantity").alias("kw_demand"),
        F.col("l_tax").cast(MONEY).alias("kvarh"),
        F.date_trunc("day", F.col("l_shipdate")).alias("dt"),
    )


def silver_energy_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events -> fine-grained meter readings (sub-second timestamps)."""
    e = read_table(spark, sf_dir, "events")
    return e.select(
        F.col("ts").alias("timestamp"),
        F.concat(F.lit("N"), (F.col("user_id") % 25).cast("string")).alias("site_code"),
        F.col("event_type").alias("line_code"),
        F.concat(F.lit("E"), F.col("user_id").cast("string")).alias("equip_code"),
        F.col("value").cast(MONEY).alias("kwh"),
        F.get_json_object("props", "$.k").try_cast("double").alias("kw_demand"),
        (F.col("value") / 10).alias("kvarh"),
        F.date_trunc("day", F.col("ts")).alias("dt"),
    )


# DuckDB text of the same adapters, used by the oracle queries.
SQL_SILVER = {
    "silver_costs": """
    SELECT date_trunc('month', o_orderdate) AS ref_month,
           'N' || CAST(c_nationkey AS VARCHAR) AS site_code,
           o_orderpriority AS cost_center, o_orderstatus AS account_code,
           'status ' || o_orderstatus AS account_name,
           CAST(o_totalprice AS DECIMAL(15,2)) AS amount_br,
           o_totalprice * (1 - CAST(o_orderkey % 7 AS DOUBLE) / 100)
             / (1 + CAST(o_orderkey % 10 AS DOUBLE) / 100) AS amount_fx,
           1 + CAST(o_orderkey % 10 AS DOUBLE) / 100 AS fx_rate
    FROM orders JOIN customer ON o_custkey = c_custkey""",
    "silver_manufacturing": """
    SELECT l_shipdate AS date,
           'N' || CAST(s_nationkey AS VARCHAR) AS site_code,
           'L' || CAST(l_suppkey AS VARCHAR) AS line_code,
           'P' || CAST(l_partkey AS VARCHAR) AS product_code,
           CAST(trunc(l_quantity) AS BIGINT) AS units_ok,
           CAST(trunc(l_quantity * l_discount) AS BIGINT) AS units_rework,
           CAST(trunc(l_quantity * l_tax) AS BIGINT) AS scrap_units,
           l_extendedprice / NULLIF(l_quantity, 0) AS takt_time_s,
           1 - l_discount AS oee
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey""",
    "silver_energy": """
    SELECT l_shipdate AS timestamp,
           'N' || CAST(s_nationkey AS VARCHAR) AS site_code,
           'L' || CAST(l_suppkey AS VARCHAR) AS line_code,
           'E' || CAST(l_linenumber AS VARCHAR) AS equip_code,
           CAST(l_extendedprice AS DECIMAL(15,2)) AS kwh, l_quantity AS kw_demand,
           CAST(l_tax AS DECIMAL(15,2)) AS kvarh
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey""",
    "silver_energy_events": """
    SELECT ts AS timestamp,
           'N' || CAST(user_id % 25 AS VARCHAR) AS site_code,
           event_type AS line_code,
           'E' || CAST(user_id AS VARCHAR) AS equip_code,
           CAST(value AS DECIMAL(15,2)) AS kwh,
           TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS kw_demand,
           value / 10 AS kvarh
    FROM events""",
}
