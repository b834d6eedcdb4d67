"""Inspection operators A16-A18 on the driver tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from ordertide.catalog import query, table
from ordertide.sources import io

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


@query("table_row_counts", oracle="\nUNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in TABLES))
def table_row_counts(spark, sf):
    """Rows per table (each count is a metadata-light scan with partial counts)."""
    parts = [table(spark, sf, t).select(F.lit(t).alias("table_name")) for t in TABLES]
    return (reduce(lambda a, b: a.unionByName(b), parts)
            .groupBy("table_name").agg(F.count(F.lit(1)).alias("n_rows")))


@query("date_range_orders", oracle="""
SELECT CAST(min(o_orderdate) AS DATE) AS min_date, CAST(max(o_orderdate) AS DATE) AS max_date FROM orders
""")
def date_range_orders(spark, sf):
    """First and last order date."""
    o = table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("order_date"))
    return io.date_range(o, "order_date")


@query("preview_lines")
def preview_lines(spark, sf):
    """Ad-hoc preview, LIMIT 1000 (the limit is the feature; rows-only)."""
    return io.head(table(spark, sf, "lineitem").filter(F.col("l_returnflag") == "R"), 1000)
