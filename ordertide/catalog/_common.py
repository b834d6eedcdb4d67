
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordertide.catalog import table

# Tie-break for picking one lineitem version: together with the key columns
# and l_shipdate this lists every column, so the pick is unique.
LINE_TIEBREAK_COLS = ["l_partkey", "l_quantity", "l_extendedprice", "l_discount",
                      "l_tax", "l_returnflag", "l_linestatus"]


def line_tiebreak_desc():
    return [F.desc(c) for c in LINE_TIEBREAK_COLS]


def line_tiebreak_asc():
    return [F.asc(c) for c in LINE_TIEBREAK_COLS]


SQL_TIEBREAK_DESC = ", ".join(f"{c} DESC" for c in LINE_TIEBREAK_COLS)
SQL_TIEBREAK_ASC = ", ".join(f"{c} ASC" for c in LINE_TIEBREAK_COLS)


def order_country(spark: SparkSession, sf: str) -> DataFrame:
    """o_orderkey -> country (customer nation name) and order date."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf, "nation").select("n_nationkey", F.col("n_name").alias("country_code"))
    return (o.join(c, o.o_custkey == c.c_custkey)
            .join(F.broadcast(n), c.c_nationkey == n.n_nationkey)  # 25-row dimension
            .select("o_orderkey", "o_orderdate", "country_code"))


SQL_ORDER_COUNTRY = """
SELECT o.o_orderkey, o.o_orderdate, n.n_name AS country_code
FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey
JOIN nation n ON n.n_nationkey = c.c_nationkey
"""


def change_log(spark: SparkSession, sf: str) -> DataFrame:
    """Stock change log stand-in: key user_id, time ts, quantity floor(value / 25)."""
    e = table(spark, sf, "events")
    return e.select(F.col("user_id").alias("item_id"), F.col("ts").alias("modify_date_time"),
                    F.floor(F.col("value") / 25).cast("double").alias("availability_qty"))


SQL_CHANGE_LOG = """
SELECT user_id AS item_id, ts AS modify_date_time,
       CAST(floor(value / 25) AS DOUBLE) AS availability_qty
FROM events
"""
