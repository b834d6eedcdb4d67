"""Dedup family on lineitem versions: E1-E5, B12, B14, B26, F1/F2."""

from __future__ import annotations

from pyspark.sql import functions as F

from ordertide.catalog import query, table
from ordertide.catalog._common import (SQL_TIEBREAK_ASC, SQL_TIEBREAK_DESC,
                                       line_tiebreak_asc, line_tiebreak_desc)
from ordertide.operators.relational import (any_per_key, earliest_per_key,
                                            latest_per_key, smallest_measure_per_key)

LINE = ["l_orderkey", "l_linenumber"]


@query("latest_line", oracle=f"""
SELECT * FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_shipdate DESC NULLS LAST, l_suppkey DESC, {SQL_TIEBREAK_DESC}) = 1
""")
def latest_line(spark, sf):
    """E1 + B14: latest version of each line, NULL dates last, full tie-break."""
    li = table(spark, sf, "lineitem")
    return latest_per_key(li, LINE, [F.desc_nulls_last("l_shipdate")],
                          [F.desc("l_suppkey"), *line_tiebreak_desc()])


@query("earliest_line", oracle=f"""
SELECT *, CAST(l_linenumber AS BIGINT) AS line_no_int FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_shipdate ASC NULLS FIRST, l_suppkey ASC, {SQL_TIEBREAK_ASC}) = 1
""")
def earliest_line(spark, sf):
    """E2 + F1/F2: earliest version per line, output sorted by the integer line key."""
    li = table(spark, sf, "lineitem")
    first = earliest_per_key(li, LINE, ["l_shipdate"], [F.asc("l_suppkey"), *line_tiebreak_asc()])
    return (first.withColumn("line_no_int", F.col("l_linenumber").cast("bigint"))
            .orderBy("l_orderkey", "line_no_int"))


@query("any_per_key_deterministic", oracle="""
SELECT l_suppkey, l_returnflag, l_orderkey, l_linenumber, l_quantity FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_suppkey, l_returnflag
        ORDER BY l_orderkey ASC NULLS FIRST, l_linenumber ASC NULLS FIRST,
                 l_quantity ASC NULLS FIRST) = 1
""")
def any_per_key_deterministic(spark, sf):
    """One row per key without a meaningful order, made deterministic."""
    li = table(spark, sf, "lineitem").select("l_suppkey", "l_returnflag", "l_orderkey",
                                             "l_linenumber", "l_quantity")
    return any_per_key(li, ["l_suppkey", "l_returnflag"])


@query("distinct_delivery_status", oracle="""
SELECT DISTINCT l_suppkey, l_returnflag, l_linestatus FROM lineitem
""")
def distinct_delivery_status(spark, sf):
    """Distinct rows."""
    return table(spark, sf, "lineitem").select("l_suppkey", "l_returnflag", "l_linestatus").distinct()


@query("smallest_measure_wins", oracle="""
SELECT * FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber, l_shipdate
        ORDER BY l_quantity ASC, l_suppkey ASC, l_partkey ASC, l_extendedprice ASC,
                 l_discount ASC, l_tax ASC, l_returnflag ASC, l_linestatus ASC) = 1
""")
def smallest_measure_wins(spark, sf):
    """E5: duplicates at one timestamp resolved by the smallest measure."""
    li = table(spark, sf, "lineitem")
    tb = [F.asc(c) for c in ["l_suppkey", "l_partkey", "l_extendedprice", "l_discount",
                             "l_tax", "l_returnflag", "l_linestatus"]]
    return smallest_measure_per_key(li, [*LINE, "l_shipdate"], "l_quantity", tb)


@query("first_status_order_date", oracle=f"""
WITH r AS (
  SELECT l.l_orderkey, l.l_linenumber, l.l_suppkey, l.l_partkey, l.l_linestatus,
         l.l_shipdate, o.o_orderdate,
         row_number() OVER (PARTITION BY l.l_orderkey, l.l_linenumber
                            ORDER BY l.l_shipdate ASC NULLS FIRST, l.l_suppkey ASC,
                                     {', '.join('l.' + c for c in SQL_TIEBREAK_ASC.split(', '))}) AS version_no
  FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey)
SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey, version_no,
       CASE WHEN l_linestatus = 'O' AND version_no = 1 THEN o_orderdate ELSE l_shipdate END AS status_date
FROM r
""")
def first_status_order_date(spark, sf):
    """E4 + B26: row number kept as a value; the first open version takes the order date."""
    li = table(spark, sf, "lineitem")
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    from pyspark.sql import Window
    w = Window.partitionBy(*LINE).orderBy(F.asc("l_shipdate"), F.asc("l_suppkey"), *line_tiebreak_asc())
    r = (li.join(o, li.l_orderkey == o.o_orderkey)
         .withColumn("version_no", F.row_number().over(w).cast("bigint")))
    return r.select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "version_no",
                    F.when((F.col("l_linestatus") == "O") & (F.col("version_no") == 1),
                           F.col("o_orderdate")).otherwise(F.col("l_shipdate")).alias("status_date"))
