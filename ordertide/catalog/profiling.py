"""Profiling queries: D21-D28, D30 on orders / customer / labels / lineitem / part."""

from __future__ import annotations

from pyspark.sql import functions as F

from ordertide.catalog import query, table
from ordertide.operators import profile as P

# orders with NULLs injected in the query itself (the table has none)
_ORDERS_NULLS_SQL = """
SELECT o_orderkey, o_custkey, o_orderstatus,
       CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_totalprice END AS o_totalprice,
       o_orderdate,
       CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderpriority END AS o_orderpriority
FROM orders
"""
_ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


def orders_with_nulls(spark, sf):
    o = table(spark, sf, "orders")
    return o.select("o_orderkey", "o_custkey", "o_orderstatus",
                    F.when(F.col("o_orderstatus") == "F", None).otherwise(F.col("o_totalprice")).alias("o_totalprice"),
                    "o_orderdate",
                    F.when(F.col("o_orderpriority") == "5-LOW", None).otherwise(F.col("o_orderpriority"))
                    .alias("o_orderpriority"))


def _sql_missing(src: str, cols, numeric) -> str:
    parts = []
    for c in cols:
        miss = f"{c} IS NULL" + (f" OR isnan({c})" if c in numeric else "")
        parts.append(f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {miss}) AS n_missing, "
                     f"round(100.0 * count(*) FILTER (WHERE {miss}) / count(*), 4) AS pct_missing FROM s")
    return f"WITH s AS ({src})\n" + "\nUNION ALL ".join(parts)


@query("missing_profile", oracle=_sql_missing(_ORDERS_NULLS_SQL, _ORDER_COLS, {"o_totalprice"}))
def missing_profile(spark, sf):
    return P.missing_profile(orders_with_nulls(spark, sf), _ORDER_COLS)


@query("null_share_positives", oracle=_sql_missing(
    _ORDERS_NULLS_SQL.replace("FROM orders", "FROM orders WHERE o_orderstatus = 'O'"),
    _ORDER_COLS, {"o_totalprice"}))
def null_share_positives(spark, sf):
    """Missing profile among the rows of one class."""
    return P.null_share_among(orders_with_nulls(spark, sf), F.col("o_orderstatus") == "O", _ORDER_COLS)


@query("binary_prevalence", oracle="\nUNION ALL ".join(
    f"SELECT '{c}' AS column_name, round(avg({c}), 6) AS mean, round(100 * avg({c}), 4) AS pct_ones, "
    f"CAST(sum({c}) AS BIGINT) AS n_ones, count({c}) AS n FROM labels" for c in ("quality", "toxic")))
def binary_prevalence(spark, sf):
    return P.binary_prevalence(table(spark, sf, "labels"), ["quality", "toxic"])


_DESC_COLS = ["c_acctbal", "c_nationkey", "c_custkey"]
_PROBS = [(0.01, "p01"), (0.05, "p05"), (0.5, "p50"), (0.95, "p95"), (0.99, "p99")]


@query("describe_percentiles", oracle="\nUNION ALL ".join(
    f"SELECT '{c}' AS column_name, count({c}) AS count, round(avg({c}), 4) AS mean, "
    f"round(stddev_samp({c}), 4) AS std, CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max, "
    + ", ".join(f"round(CAST(quantile_cont({c}, {p}) AS DOUBLE), 4) AS {n}" for p, n in _PROBS)
    + " FROM customer" for c in _DESC_COLS))
def describe_percentiles(spark, sf):
    """D25 with exact interpolated percentiles."""
    return P.describe(table(spark, sf, "customer"), _DESC_COLS, [p for p, _ in _PROBS])


_CORR_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("corr_matrix", oracle="\nUNION ALL ".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr({a}, {b}), 6) AS corr FROM lineitem"
    for i, a in enumerate(_CORR_COLS) for b in _CORR_COLS[i:]))
def corr_matrix(spark, sf):
    return P.corr_matrix(table(spark, sf, "lineitem"), _CORR_COLS)


@query("value_counts", oracle="""
SELECT c_mktsegment, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 4) AS share_pct
FROM customer GROUP BY c_mktsegment
""")
def value_counts(spark, sf):
    return P.value_counts(table(spark, sf, "customer"), "c_mktsegment")


@query("cardinality", oracle="\nUNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS n_distinct FROM part"
    for c in ("p_brand", "p_type", "p_size")))
def cardinality(spark, sf):
    """Distinct values per categorical column."""
    return P.cardinality(table(spark, sf, "part"), ["p_brand", "p_type", "p_size"])


@query("group_size_quartiles", oracle="""
WITH c AS (SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY l_suppkey)
SELECT quantile_cont(n, 0.25) AS q25, quantile_cont(n, 0.75) AS q75 FROM c
""")
def group_size_quartiles(spark, sf):
    """Interpolated quartiles of the number of lines per ship node."""
    c = table(spark, sf, "lineitem").groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n"))
    return P.group_size_quartiles(c)
