"""Preparation queries: I1-I4, I6, I7, I9-I17, I20-I23, I25, I27-I29, I32."""

from __future__ import annotations

from pyspark.sql import functions as F

from ordertide.catalog import ORACLES, query, table
from ordertide.fixed import UNKNOWN
from ordertide.functions.scalars import share_or_zero
from ordertide.operators import prep as X
from ordertide.operators import profile as P


# --------------------------------------------------------------------------
# I1 + I2 + I4: median and mode imputation on lineitem with injected NULLs
# --------------------------------------------------------------------------

def _lines_with_nulls(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey",
                     F.when(F.col("l_linenumber") == 3, None).otherwise(F.col("l_quantity")).alias("l_quantity"),
                     F.when(F.col("l_linenumber") == 5, None).otherwise(F.col("l_returnflag")).alias("l_returnflag"),
                     F.when(F.col("l_linenumber") == 7, None).otherwise(F.col("l_linestatus")).alias("l_linestatus"))


_SQL_LINES_NULLS = """
s AS (SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey,
             CASE WHEN l_linenumber = 3 THEN NULL ELSE l_quantity END AS l_quantity,
             CASE WHEN l_linenumber = 5 THEN NULL ELSE l_returnflag END AS l_returnflag,
             CASE WHEN l_linenumber = 7 THEN NULL ELSE l_linestatus END AS l_linestatus
      FROM lineitem)
"""


@query("impute_median_mode", oracle="WITH " + _SQL_LINES_NULLS + """,
med AS (SELECT quantile_cont(l_quantity, 0.5) AS m FROM s),
mode_f AS (SELECT l_returnflag AS m FROM s WHERE l_returnflag IS NOT NULL GROUP BY l_returnflag
           ORDER BY count(*) DESC, l_returnflag ASC LIMIT 1)
SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey,
       coalesce(l_quantity, (SELECT m FROM med)) AS l_quantity,
       coalesce(l_returnflag, (SELECT m FROM mode_f)) AS l_returnflag,
       coalesce(l_linestatus, 'Unknown') AS l_linestatus
FROM s
""")
def impute_median_mode(spark, sf):
    s = _lines_with_nulls(spark, sf)
    values = {**X.fit_medians(s, ["l_quantity"]), **X.fit_modes(s, ["l_returnflag"]),
              "l_linestatus": UNKNOWN}                                   # I4 constant
    return X.fill(s, values)


@query("group_median_fill", oracle="WITH " + _SQL_LINES_NULLS + """
SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey,
       round(coalesce(l_quantity, quantile_cont(l_quantity, 0.5) OVER (PARTITION BY l_suppkey, l_returnflag)), 4) AS l_quantity,
       l_returnflag, l_linestatus
FROM s
""")
def group_median_fill(spark, sf):
    """Missing quantities filled by the median of the ship node and return flag (null flags are a group)."""
    out = X.group_median_fill(_lines_with_nulls(spark, sf), "l_quantity", ["l_suppkey", "l_returnflag"])
    return out.withColumn("l_quantity", F.round("l_quantity", 4))


@query("impute_max_plus_one", oracle=None)
def impute_max_plus_one(spark, sf):
    """Days since the last stockout, 'never' filled with max + 1."""
    from ordertide.catalog.joins import last_stockout
    d = last_stockout(spark, sf).select("item_id", "modify_date_time", "days_since_last_stockout")
    return X.fill(d, X.fit_max_plus_one(d, ["days_since_last_stockout"]))


ORACLES["impute_max_plus_one"] = f"""
WITH x AS ({ORACLES['last_stockout']}),
m AS (SELECT max(days_since_last_stockout) + 1 AS v FROM x)
SELECT item_id, modify_date_time, coalesce(days_since_last_stockout, (SELECT v FROM m)) AS days_since_last_stockout
FROM x
"""


# --------------------------------------------------------------------------
# I6 + I7: one-hot (first level dropped) and population standardisation
# --------------------------------------------------------------------------

_SEGMENTS = ["BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]   # levels after the first


@query("one_hot_drop_first", oracle="SELECT c_custkey, " + ", ".join(
    f"CAST(c_mktsegment = '{v}' AS INTEGER) AS c_mktsegment_{v}" for v in _SEGMENTS) + " FROM customer")
def one_hot_drop_first(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return X.one_hot(c, "c_mktsegment", X.levels(c, "c_mktsegment"), drop_first=True)


@query("standardise_pop", oracle="""
SELECT c_custkey,
       round((c_acctbal - avg(c_acctbal) OVER ()) / stddev_pop(c_acctbal) OVER (), 6) AS c_acctbal,
       round((c_nationkey - avg(c_nationkey) OVER ()) / stddev_pop(c_nationkey) OVER (), 6) AS c_nationkey
FROM customer
""")
def standardise_pop(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_acctbal", "c_nationkey")
    z = X.standardise(c, X.fit_standardiser(c, ["c_acctbal", "c_nationkey"]))
    return z.withColumns({k: F.round(k, 6) for k in ("c_acctbal", "c_nationkey")})


# --------------------------------------------------------------------------
# I9 + I10 + I12: rare grouping, count / frequency encoding, hybrid encoder
# --------------------------------------------------------------------------

@query("count_freq_encode", oracle="""
SELECT p.p_partkey, p.p_brand, c.p_brand_count, round(c.p_brand_freq, 8) AS p_brand_freq
FROM part p JOIN (SELECT p_brand, count(*) AS p_brand_count, count(*) / (SELECT count(*) FROM part) AS p_brand_freq
                  FROM part GROUP BY p_brand) c ON c.p_brand = p.p_brand
""")
def count_freq_encode(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", "p_brand")
    out = X.count_freq_encode(p, "p_brand", X.category_counts(p, "p_brand"))
    return out.withColumn("p_brand_freq", F.round("p_brand_freq", 8))


@query("rare_group", oracle="""
SELECT d.doc_id, CASE WHEN d.lang IS NULL THEN NULL WHEN c.n >= 110 THEN d.lang ELSE 'OTHER' END AS lang
FROM documents d LEFT JOIN (SELECT lang, count(*) AS n FROM documents GROUP BY lang) c ON c.lang = d.lang
""")
def rare_group(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "lang")
    return X.rare_group(d, "lang", 110)


@query("hybrid_encode", oracle="""
WITH c0 AS (SELECT lang, count(*) AS n FROM documents GROUP BY lang),
g AS (SELECT d.doc_id, CASE WHEN d.lang IS NULL THEN NULL WHEN c0.n >= 110 THEN d.lang ELSE 'OTHER' END AS lang
      FROM documents d LEFT JOIN c0 ON c0.lang = d.lang),
c AS (SELECT lang, count(*) AS lang_count, count(*) / (SELECT count(*) FROM g) AS lang_freq FROM g GROUP BY lang)
SELECT g.doc_id, g.lang, c.lang_count, round(c.lang_freq, 8) AS lang_freq,
       CAST(g.lang = 'de' AS INTEGER) AS lang_de, CAST(g.lang = 'en' AS INTEGER) AS lang_en,
       CAST(g.lang = 'fr' AS INTEGER) AS lang_fr
FROM g LEFT JOIN c ON c.lang = g.lang
""")
def hybrid_encode(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "lang")
    model = X.HybridEncoder(inputCol="lang", minCount=110, dropFirst=True).fit(d)
    out = model.transform(d)
    return out.select("doc_id", "lang", "lang_count", F.round("lang_freq", 8).alias("lang_freq"),
                      *[c for c in out.columns if c.startswith("lang_") and c not in ("lang_count", "lang_freq")])


# --------------------------------------------------------------------------
# I13 + I14 + I15 + I17: tiers, top-N, rare flags, zero-guarded shares
# --------------------------------------------------------------------------

@query("node_tier", oracle="""
WITH c AS (SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY l_suppkey),
q AS (SELECT quantile_cont(n, 0.25) AS q25, quantile_cont(n, 0.75) AS q75 FROM c)
SELECT l_suppkey, n, CASE WHEN n >= q75 THEN 'LARGE' WHEN n >= q25 THEN 'MEDIUM' ELSE 'SMALL' END AS tier
FROM c, q
""")
def node_tier(spark, sf):
    return X.frequency_tiers(table(spark, sf, "lineitem"), "l_suppkey")


@query("top_n_other", oracle="""
WITH j AS (SELECT p.p_brand FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey),
top AS (SELECT p_brand FROM j GROUP BY p_brand ORDER BY count(*) DESC, p_brand ASC LIMIT 10)
SELECT CASE WHEN p_brand IN (SELECT p_brand FROM top) THEN p_brand ELSE 'OTHER' END AS brand_group,
       count(*) AS n_lines
FROM j GROUP BY 1
""")
def top_n_other(spark, sf):
    li = table(spark, sf, "lineitem").select("l_partkey")
    p = table(spark, sf, "part").select("p_partkey", "p_brand")
    j = li.join(p, li.l_partkey == p.p_partkey).select("p_brand")
    keep = X.top_n_levels(j, "p_brand", 10)
    g = X.top_n_other(j, "p_brand", keep).withColumnRenamed("p_brand", "brand_group")
    return g.groupBy("brand_group").agg(F.count(F.lit(1)).alias("n_lines"))


_FLAGS = {
    "f_qty_50": "l_quantity = 50",
    "f_tax_zero": "l_tax = 0",
    "f_price_104900": "l_extendedprice > 104900",
    "f_qty_over_50": "l_quantity > 50",
}


@query("rare_flag_merge", oracle="\nUNION ALL ".join(
    f"SELECT '{n}' AS flag, CAST(sum(CAST({e} AS INTEGER)) AS BIGINT) AS n_ones, "
    f"CASE WHEN sum(CAST({e} AS INTEGER)) = 0 THEN 'drop' WHEN sum(CAST({e} AS INTEGER)) < 20 THEN 'merge' "
    f"ELSE 'keep' END AS action FROM lineitem" for n, e in _FLAGS.items()))
def rare_flag_merge(spark, sf):
    """Decision table for rare / empty 0-1 flags."""
    li = table(spark, sf, "lineitem").select(*[F.expr(e).cast("int").alias(n) for n, e in _FLAGS.items()])
    return X.rare_flag_plan(li, list(_FLAGS), min_ones=20)


@query("share_zero_guard", oracle="""
SELECT l_orderkey, l_suppkey, sum(l_quantity) AS total_qty,
       sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END) AS returned_qty,
       round(coalesce(sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END)
                      / nullif(sum(CASE WHEN l_discount = 0 THEN 0 ELSE l_quantity END), 0), 0), 6) AS returned_share
FROM lineitem GROUP BY l_orderkey, l_suppkey
""")
def share_zero_guard(spark, sf):
    """I16 + I17: group sums and a share whose zero denominator gives 0."""
    li = table(spark, sf, "lineitem")
    g = li.groupBy("l_orderkey", "l_suppkey").agg(
        F.sum("l_quantity").alias("total_qty"),
        F.sum(F.when(F.col("l_returnflag") == "R", F.col("l_quantity")).otherwise(0.0)).alias("returned_qty"),
        F.sum(F.when(F.col("l_discount") == 0, 0.0).otherwise(F.col("l_quantity"))).alias("__den"))
    return g.select("l_orderkey", "l_suppkey", "total_qty", "returned_qty",
                    F.round(share_or_zero("returned_qty", "__den"), 6).alias("returned_share"))


# --------------------------------------------------------------------------
# I20-I23 + I27: quality checks on lineitem with injected problem columns
# --------------------------------------------------------------------------

def _lines_with_issues(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_discount", "l_returnflag",
                     F.lit(1).alias("const_col"),
                     F.lit(None).cast("double").alias("all_null_col"),
                     F.when(F.col("l_discount") == 0, float("inf")).otherwise(F.col("l_discount")).alias("inf_col"),
                     F.col("l_quantity").alias("dup_col"),
                     F.when(F.col("l_linenumber") == 1, None).otherwise(F.col("l_tax")).alias("some_null_col"))


_ISSUE_COLS = ["l_quantity", "l_discount", "l_returnflag", "const_col", "all_null_col", "inf_col", "dup_col",
               "some_null_col"]


@query("quality_issues", oracle="""
WITH s AS (SELECT l_linenumber, l_quantity, l_discount, l_returnflag, 1 AS const_col, CAST(NULL AS DOUBLE) AS all_null_col,
                  CASE WHEN l_discount = 0 THEN CAST('inf' AS DOUBLE) ELSE l_discount END AS inf_col,
                  l_quantity AS dup_col, CASE WHEN l_linenumber = 1 THEN NULL ELSE l_tax END AS some_null_col
           FROM lineitem)
SELECT 'all_null_col' AS column_name, 'high_null_share' AS issue, 100.0 AS value
UNION ALL SELECT 'some_null_col', 'has_nulls', CAST(count(*) FILTER (WHERE some_null_col IS NULL) AS DOUBLE) FROM s
UNION ALL SELECT 'inf_col', 'infinite_values', CAST(count(*) FILTER (WHERE isinf(inf_col)) AS DOUBLE) FROM s
UNION ALL SELECT 'const_col', 'constant', 1.0
UNION ALL SELECT 'all_null_col', 'constant', 0.0
""")
def quality_issues(spark, sf):
    return P.quality_issues(_lines_with_issues(spark, sf), _ISSUE_COLS)


@query("inf_to_null", oracle="""
SELECT l_orderkey, l_linenumber, l_suppkey, nullif(l_discount, 0) AS inf_col, l_quantity AS dup_col FROM lineitem
""")
def inf_to_null(spark, sf):
    """Infinite values become gaps."""
    out = P.inf_to_null(_lines_with_issues(spark, sf), ["inf_col", "dup_col"])
    return out.select("l_orderkey", "l_linenumber", "l_suppkey", "inf_col", "dup_col")


@query("constant_columns", oracle="""
SELECT 'const_col' AS column_name, CAST(1 AS BIGINT) AS n_distinct
UNION ALL SELECT 'all_null_col', CAST(0 AS BIGINT)
""")
def constant_columns(spark, sf):
    return P.constant_columns(_lines_with_issues(spark, sf), _ISSUE_COLS)


@query("duplicate_columns", oracle="SELECT 'l_quantity' AS col_a, 'dup_col' AS col_b")
def duplicate_columns(spark, sf):
    d = _lines_with_issues(spark, sf)
    return P.duplicate_columns(d, ["l_quantity", "l_discount", "inf_col", "dup_col", "some_null_col"],
                               ["l_orderkey", "l_linenumber", "l_suppkey"])


@query("coercion_loss", oracle="""
SELECT 'o_orderpriority' AS column_name, count(*) FILTER (WHERE TRY_CAST(o_orderpriority AS DOUBLE) IS NULL) AS n_lost
FROM orders
UNION ALL SELECT 'o_digit', count(*) FILTER (WHERE TRY_CAST(substr(o_orderpriority, 1, 1) AS DOUBLE) IS NULL) FROM orders
""")
def coercion_loss(spark, sf):
    """Values lost when text columns are coerced to numbers."""
    o = table(spark, sf, "orders").select("o_orderpriority",
                                          F.substring("o_orderpriority", 1, 1).alias("o_digit"))
    return P.coercion_loss(o, ["o_orderpriority", "o_digit"])


# --------------------------------------------------------------------------
# I25 + E20: time-ordered 80 / 20 split; I28 / I29 samples; I32 indicators
# --------------------------------------------------------------------------

@query("time_split", oracle="""
SELECT o_orderkey, o_orderdate,
       CASE WHEN row_number() OVER (ORDER BY o_orderdate, o_orderkey) <= floor(0.8 * count(*) OVER ())
            THEN 'train' ELSE 'test' END AS split
FROM orders
""")
def time_split(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return X.time_split(o, "o_orderdate", ["o_orderkey"], 0.8)


_SQL_HASH = "CAST('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 15) AS BIGINT)"


@query("hash_sample", oracle=f"SELECT o_orderkey, o_orderstatus FROM orders WHERE {_SQL_HASH} % 10 = 0")
def hash_sample(spark, sf):
    """10 % hash sample by order key."""
    return X.hash_sample(table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), ["o_orderkey"])


@query("ratio_sample", oracle=f"""
WITH o AS (SELECT o_orderkey, o_orderpriority, CAST(o_orderstatus = 'F' AS INT) AS label, {_SQL_HASH} AS h FROM orders),
n AS (SELECT *, (SELECT count(*) FROM o p WHERE p.label = 1 AND p.o_orderpriority = o.o_orderpriority) AS n_pos,
             count(*) OVER (PARTITION BY o_orderpriority, label ORDER BY h, o_orderkey ROWS UNBOUNDED PRECEDING) AS k FROM o)
SELECT o_orderkey, o_orderpriority, label FROM n WHERE label = 1 OR k <= 3 * n_pos
""")
def ratio_sample(spark, sf):
    """Positives (status 'F') plus three times as many negatives, per priority."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority",
                                          (F.col("o_orderstatus") == "F").cast("int").alias("label"))
    return X.ratio_sample(o, "label", ["o_orderkey"], 3.0, ["o_orderpriority"])


_PRIOS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", None]


@query("level_indicators", oracle="SELECT o_orderkey, " + ", ".join(
    f"CAST(p IS NOT DISTINCT FROM {'NULL' if v is None else repr(v)} AS INTEGER) AS "
    f"\"prio_{'null' if v is None else v.replace(' ', '_')}\"" for v in _PRIOS)
    + " FROM (SELECT o_orderkey, CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderpriority END AS p "
      "FROM orders)")
def level_indicators(spark, sf):
    """I32: one indicator per level, NULL included."""
    o = table(spark, sf, "orders").select("o_orderkey", F.when(F.col("o_orderpriority") == "5-LOW", None)
                 .otherwise(F.col("o_orderpriority")).alias("p"))
    return X.level_indicators(o, "p", _PRIOS, "prio").drop("p")


# --------------------------------------------------------------------------
# I8 (+ I1, I2, I6, I7, I10-I12): preparation in one call, sparse features with kept state
# --------------------------------------------------------------------------

@query("prepare_table", oracle="""
WITH s AS (SELECT o_orderkey, CASE WHEN o_orderstatus <> 'F' THEN o_totalprice END AS price,
                  CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END AS priority, o_orderstatus AS status FROM orders),
f AS (SELECT o_orderkey, coalesce(price, (SELECT quantile_cont(price, 0.5) FROM s)) AS price, status,
             coalesce(priority, (SELECT priority FROM s WHERE priority IS NOT NULL GROUP BY priority ORDER BY count(*) DESC, priority LIMIT 1)) AS priority
      FROM s)
SELECT o_orderkey, round((price - (SELECT avg(price) FROM f)) / (SELECT stddev_pop(price) FROM f), 6) AS z_price,
       nullif(priority, (SELECT min(priority) FROM f)) AS priority_level, nullif(status, (SELECT min(status) FROM f)) AS status_level
FROM f
""")
def prepare_table(spark, sf):
    """I8: fills, scales and encodes in one call; the entries of each row's sparse vector, read back by name."""
    from pyspark.ml.functions import vector_to_array
    from ordertide.operators.tables import TablePreparer, named_entries
    o = table(spark, sf, "orders").select(
        "o_orderkey", F.when(F.col("o_orderstatus") != "F", F.col("o_totalprice")).alias("price"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("priority"), F.col("o_orderstatus").alias("status"))
    model = TablePreparer(numericCols=["price"], categoricalCols=["priority", "status"]).fit(o)
    out = model.transform(o)
    names = named_entries(model, out, ["o_orderkey"]).groupBy("o_orderkey").pivot("column_name", ["priority", "status"]).agg(F.first("level"))
    return out.select("o_orderkey", F.round(vector_to_array("features")[0], 6).alias("z_price")).join(names, "o_orderkey", "left").withColumnsRenamed(
        {"priority": "priority_level", "status": "status_level"})
