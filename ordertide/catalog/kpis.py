"""K11 / K12 business KPIs on lineitem + orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from ordertide.catalog import query, table
from ordertide.catalog._common import (SQL_ORDER_COUNTRY, SQL_TIEBREAK_DESC,
                                       line_tiebreak_desc, order_country)
from ordertide.plans.kpis import delivery_summary, delivery_totals


def _per_delivery(spark, sf):
    li = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_suppkey", "l_linenumber", "l_shipdate", "l_partkey", "l_quantity",
        "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
        F.col("l_extendedprice").cast("decimal(18,2)").alias("line_total_euros"))
    per = delivery_totals(li, ["l_orderkey", "l_suppkey"], ["l_linenumber"], "l_quantity",
                          "line_total_euros", [F.desc_nulls_last("l_shipdate")],
                          line_tiebreak_desc())
    # pre-aggregated per delivery before the order / country join
    return per.join(order_country(spark, sf), per.l_orderkey == F.col("o_orderkey"))


_SQL_PER_DELIVERY = f"""
WITH v AS (
  SELECT l_orderkey, l_suppkey, l_quantity, CAST(l_extendedprice AS DECIMAL(18,2)) AS val
  FROM lineitem
  QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_suppkey, l_linenumber
                             ORDER BY l_shipdate DESC NULLS LAST, {SQL_TIEBREAK_DESC}) = 1),
d AS (SELECT l_orderkey, l_suppkey, sum(l_quantity) AS total_ordered_qty,
             sum(val) AS total_euros FROM v GROUP BY l_orderkey, l_suppkey),
oc AS ({SQL_ORDER_COUNTRY}),
dc AS (SELECT d.*, oc.country_code FROM d JOIN oc ON oc.o_orderkey = d.l_orderkey)
"""

_SQL_SUMMARY_COLS = """
  CAST(sum(total_ordered_qty) AS DOUBLE) AS total_ordered_qty,
  CAST(sum(total_euros) AS DOUBLE) AS total_euros,
  round(CAST(avg(total_ordered_qty) AS DOUBLE), 4) AS avg_ordered_qty,
  round(CAST(avg(total_euros) AS DOUBLE), 4) AS avg_euros,
  count(*) AS n_deliveries
"""


@query("delivery_rollup_kpi", oracle=_SQL_PER_DELIVERY + "SELECT" + _SQL_SUMMARY_COLS + "FROM dc")
def delivery_rollup_kpi(spark, sf):
    """Flagship (E1 -> D1 -> D2): latest line version, delivery sums, global KPIs."""
    return delivery_summary(_per_delivery(spark, sf))


@query("delivery_rollup_by_country",
       oracle=_SQL_PER_DELIVERY + "SELECT country_code," + _SQL_SUMMARY_COLS
       + "FROM dc GROUP BY country_code")
def delivery_rollup_by_country(spark, sf):
    return delivery_summary(_per_delivery(spark, sf), ["country_code"])
