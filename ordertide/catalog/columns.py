"""Column and row selection, typing, flags and derived columns (B11, B20-B24, B29, B30, D20, D23, I14-I16,
I18, I19, I24, I31, J25, J38)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ordertide.catalog import query, table
from ordertide.catalog.models import _SQL_ALL_FEATURES, _SQL_SCORED, FEATURES, doc_features, scored_docs
from ordertide.catalog.prep import _ISSUE_COLS, _lines_with_issues
from ordertide.functions.scalars import composite_id, hours_between
from ordertide.operators import columns as C
from ordertide.operators import prep as X
from ordertide.operators import stats as S
from ordertide.operators.profile import cardinality


@query("status_or_positive", oracle="""
SELECT l_orderkey, l_linenumber, l_suppkey, l_returnflag, CAST(l_discount >= 0.08 AS INT) AS deviation FROM lineitem
WHERE l_discount >= 0.08 OR l_returnflag = 'A'
""")
def status_or_positive(spark, sf):
    """Rows of one status and all positives."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_returnflag",
                                             (F.col("l_discount") >= 0.08).cast("int").alias("deviation"))
    return C.status_or_positive(li, "l_returnflag", "A", "deviation")


@query("keep_existing_columns", oracle="SELECT o_orderkey, o_orderstatus, 'no_such_column' AS missing FROM orders")
def keep_existing_columns(spark, sf):
    """The wanted columns that exist, the others named."""
    out, missing = C.keep_existing(table(spark, sf, "orders"), ["o_orderkey", "no_such_column", "o_orderstatus"])
    return out.withColumn("missing", F.lit(", ".join(missing)))


@query("drop_high_null_columns", oracle="""
SELECT l_orderkey, l_linenumber, l_suppkey, l_quantity, l_discount, l_returnflag, 1 AS const_col,
       CASE WHEN l_discount = 0 THEN CAST('inf' AS DOUBLE) ELSE l_discount END AS inf_col, l_quantity AS dup_col,
       CASE WHEN l_linenumber <> 1 THEN l_tax END AS some_null_col FROM lineitem
""")
def drop_high_null_columns(spark, sf):
    """B22 + B21: columns that are mostly null go."""
    return C.drop_high_null(_lines_with_issues(spark, sf))


@query("complete_rows", oracle="SELECT l_orderkey, l_linenumber, l_suppkey, l_tax AS some_null_col FROM lineitem WHERE l_linenumber <> 1")
def complete_rows(spark, sf):
    """Rows without a gap in the named columns."""
    return C.complete_rows(_lines_with_issues(spark, sf).select("l_orderkey", "l_linenumber", "l_suppkey", "some_null_col"))


@query("binary_column_list", oracle="SELECT unnest(['quality', 'toxic']) AS column_name")
def binary_column_list(spark, sf):
    """Which number columns hold only zeros and ones."""
    found = C.binary_columns(table(spark, sf, "labels"))
    return spark.createDataFrame([(c,) for c in found], "column_name string")


@query("columns_by_affix", oracle="""
SELECT unnest(['l_orderkey', 'l_partkey', 'l_suppkey']) AS column_name,
       unnest([count(DISTINCT l_orderkey), count(DISTINCT l_partkey), count(DISTINCT l_suppkey)]) AS n_distinct FROM lineitem
""")
def columns_by_affix(spark, sf):
    """Columns by prefix and suffix, with their distinct values."""
    li = table(spark, sf, "lineitem")
    return cardinality(li, C.columns_by_affix(li, "l_", "key"))


@query("composite_ids", oracle="""
SELECT l_orderkey || '_' || l_suppkey AS delivery_id, count(*) AS n_lines, count(DISTINCT l_linenumber) AS n_distinct_lines
FROM lineitem GROUP BY l_orderkey, l_suppkey
""")
def composite_ids(spark, sf):
    """A delivery id of several columns, kept apart by a separator."""
    li = table(spark, sf, "lineitem").withColumn("delivery_id", composite_id("l_orderkey", "l_suppkey"))
    return li.groupBy("delivery_id").agg(F.count(F.lit(1)).alias("n_lines"), F.count_distinct("l_linenumber").alias("n_distinct_lines"))


@query("outcomes_at_threshold", oracle=_SQL_SCORED + """
SELECT doc_id, label, score, CASE WHEN label = 1 AND score >= 0.05 THEN 'TP' WHEN label = 1 THEN 'FN' WHEN score >= 0.05 THEN 'FP' ELSE 'TN' END AS outcome
FROM sd
""")
def outcomes_at_threshold(spark, sf):
    """True positives and false negatives (and the rest) at a threshold."""
    return scored_docs(spark, sf).withColumn("outcome", C.outcome(F.col("label"), F.col("score"), 0.05))


@query("feature_histogram_by_outcome", oracle=_SQL_SCORED + """,
r AS (SELECT f.n_words, if(sd.score >= 0.05, 'TP', 'FN') AS outcome FROM f JOIN sd USING (doc_id) WHERE sd.label = 1),
b AS (SELECT min(n_words) AS lo, max(n_words) AS hi FROM r)
SELECT CAST(least(floor((n_words - lo) / ((hi - lo) / 20)), 19) AS INT) AS bin, outcome, count(*) AS n FROM r, b GROUP BY ALL
""")
def feature_histogram_by_outcome(spark, sf):
    """J38, second half: a feature's histogram among the positives, found against missed."""
    d = doc_features(spark, sf).filter("quality = 1").withColumn("score", (F.col("n_upper") + F.col("n_digits")) / F.col("n_chars"))
    return C.feature_histogram(d, "n_words", C.outcome(F.col("quality"), F.col("score"), 0.05))


_BRANDS = [f"Brand#{i}{j}" for i in range(1, 6) for j in range(1, 6)]


@query("top_flags_other", oracle="""
WITH s AS (SELECT p_partkey, CASE WHEN p_size <> 1 THEN p_brand END AS b FROM part),
known AS (SELECT unnest([""" + ", ".join(repr(b) for b in _BRANDS) + """]) AS b),
top AS (SELECT k.b FROM known k LEFT JOIN s ON s.b = k.b GROUP BY k.b ORDER BY count(s.b) DESC, replace(k.b, ' ', '_') LIMIT 5),
r AS (SELECT CASE WHEN b IS NULL THEN 'none' WHEN b IN (FROM top) THEN b WHEN b IN (SELECT b FROM known) THEN 'other' ELSE 'unknown' END AS flag FROM s)
SELECT flag, count(*) AS n FROM r WHERE flag <> 'unknown' GROUP BY flag
""")
def top_flags_other(spark, sf):
    """I14 in its flag form: five flags with the largest sums, one for the rest, the null level apart."""
    p = table(spark, sf, "part").select("p_partkey", F.when(F.col("p_size") != 1, F.col("p_brand")).alias("b"))
    wide = X.level_indicators(p, "b", [*_BRANDS, None], "brand")
    flags = [X.level_name("brand", b) for b in _BRANDS]
    out = C.top_flags(wide, [*flags, "brand_null"], 5, "brand_other", apart=["brand_null"]).drop("p_partkey", "b")
    one = out.agg(*[F.sum(c).alias(c) for c in out.columns]).unpivot([], out.columns, "flag", "n")
    name = F.when(F.col("flag") == "brand_null", "none").otherwise(F.regexp_replace("flag", "^brand_", ""))
    return one.filter("n > 0").select(name.alias("flag"), "n")


@query("merged_rare_flags", oracle="""
SELECT l_orderkey, l_linenumber, l_suppkey, CAST(l_quantity = 50 AS INT) AS f_qty_50, CAST(l_tax = 0 AS INT) AS f_tax_zero,
       CAST(l_extendedprice > 104900 AND (SELECT count(*) FROM lineitem WHERE l_extendedprice > 104900) < 20 AS INT) AS any_rare_flag
FROM lineitem
""")
def merged_rare_flags(spark, sf):
    """I15 applied: rare flags become one, empty ones go."""
    from ordertide.catalog.prep import _FLAGS
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", *[F.expr(e).cast("int").alias(n) for n, e in _FLAGS.items()])
    out = C.merge_rare_flags(li, X.rare_flag_plan(li, list(_FLAGS), min_ones=20))
    return out.select("l_orderkey", "l_linenumber", "l_suppkey", "f_qty_50", "f_tax_zero", "any_rare_flag")


@query("group_totals", oracle="""
SELECT l_orderkey, sum(l_quantity) FILTER (l_returnflag = 'A') AS qty_a, sum(l_quantity) FILTER (l_returnflag = 'N') AS qty_n,
       sum(l_quantity) FILTER (l_returnflag = 'R') AS qty_r, sum(l_quantity) FILTER (l_returnflag IN ('A', 'R')) IS NOT NULL AS moved,
       coalesce(sum(l_quantity) FILTER (l_returnflag IN ('A', 'R')), 0) AS back_total, count(DISTINCT l_returnflag) FILTER (l_returnflag IN ('A', 'R'))
         AS back_count, CAST(bool_or(l_returnflag IN ('A', 'R')) AS INT) AS has_back
FROM lineitem GROUP BY l_orderkey
""")
def group_totals(spark, sf):
    """I16: over a group of quantity columns the total, the number above zero and a flag."""
    li = table(spark, sf, "lineitem")
    qty = lambda f: F.sum(F.when(F.col("l_returnflag") == f, F.col("l_quantity"))).alias(f"qty_{f.lower()}")
    wide = li.groupBy("l_orderkey").agg(qty("A"), qty("N"), qty("R"))
    out = C.group_totals(wide.withColumn("moved", F.coalesce("qty_a", "qty_r").isNotNull()), ["qty_a", "qty_r"], "back")
    return out.withColumn("back_count", F.col("back_count").cast("bigint"))


@query("squared_terms", oracle="SELECT c_custkey, c_nationkey, CAST(c_nationkey AS DOUBLE) ^ 2 AS c_nationkey_sq FROM customer")
def squared_terms(spark, sf):
    """Squared terms beside their columns."""
    return X.squared(table(spark, sf, "customer").select("c_custkey", "c_nationkey"), ["c_nationkey"])


@query("derived_lead_times", oracle="""
SELECT l_orderkey, l_linenumber, l_suppkey, l_shipdate, round(date_sub('second', o_orderdate, l_shipdate) / 3600.0, 6) AS elapsed_hours, CAST(48 AS DOUBLE) AS remaining_hours,
       round(date_sub('second', o_orderdate, l_shipdate) / 3600.0 + 48, 6) AS lead_time_hours, CAST(48 AS DOUBLE) AS slack_hours
FROM lineitem JOIN orders ON o_orderkey = l_orderkey
""")
def derived_lead_times(spark, sf):
    """Whole lead time and slack from elapsed and remaining hours."""
    li, o = table(spark, sf, "lineitem"), table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    j = li.join(o, li.l_orderkey == o.o_orderkey).withColumns({
        "elapsed_hours": hours_between("o_orderdate", "l_shipdate"),
        "remaining_hours": hours_between("l_shipdate", F.col("l_shipdate") + F.expr("INTERVAL 2 DAYS"))})
    out = C.lead_times(j, "elapsed_hours", "remaining_hours", "lead_time_hours", "slack_hours")
    return out.select("l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate", *[F.round(c, 6).alias(c) for c in (
        "elapsed_hours", "remaining_hours", "lead_time_hours", "slack_hours")])


@query("standard_types", oracle="""
SELECT o_orderkey, CAST(o_custkey AS BIGINT) AS whole, CAST(CASE WHEN o_orderstatus <> 'F' THEN o_custkey END AS DOUBLE) AS gappy,
       CAST(o_orderstatus = 'O' AS INT) AS flag, CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS DOUBLE) AS price, o_orderpriority FROM orders
""")
def standard_types(spark, sf):
    """One type per kind of column."""
    o = table(spark, sf, "orders")
    return C.standard_types(o.select(
        "o_orderkey", F.col("o_custkey").cast("int").alias("whole"),
        F.when(F.col("o_orderstatus") != "F", F.col("o_custkey").cast("int")).alias("gappy"), (F.col("o_orderstatus") == "O").alias("flag"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("price"), "o_orderpriority"))


@query("column_roles", oracle="""
SELECT column_name, CASE WHEN column_name LIKE '%key' THEN 'id' WHEN column_type LIKE 'TIMESTAMP%' OR column_type = 'DATE' THEN 'date'
                         WHEN column_type IN ('BIGINT', 'INTEGER', 'DOUBLE') THEN 'numeric' ELSE 'categorical' END AS role,
       CASE column_name WHEN 'o_totalprice' THEN (SELECT count(DISTINCT o_totalprice) FROM orders) WHEN 'o_orderkey' THEN (SELECT count(DISTINCT o_orderkey) FROM orders)
         WHEN 'o_custkey' THEN (SELECT count(DISTINCT o_custkey) FROM orders) WHEN 'o_orderstatus' THEN (SELECT count(DISTINCT o_orderstatus) FROM orders)
         WHEN 'o_orderdate' THEN (SELECT count(DISTINCT o_orderdate) FROM orders) ELSE (SELECT count(DISTINCT o_orderpriority) FROM orders) END AS n_distinct
FROM (DESCRIBE SELECT * FROM orders)
""")
def column_roles(spark, sf):
    """Ids and dates apart from numbers and categories, with their distinct values."""
    o = table(spark, sf, "orders")
    return C.column_roles(o).join(cardinality(o, o.columns), "column_name")


@query("modelling_columns", oracle="SELECT o_orderstatus, o_totalprice, o_orderpriority FROM orders")
def modelling_columns(spark, sf):
    """I31 applied: ids and dates go."""
    return C.modelling_columns(table(spark, sf, "orders"))


@query("selected_features", oracle="WITH " + _SQL_ALL_FEATURES + """,
v AS (SELECT unnest([""" + ", ".join(f"'{c}'" for c in FEATURES) + "]) AS feature, unnest([" + ", ".join(f"var_pop({c})" for c in FEATURES) + """]) AS variance FROM f),
long AS (UNPIVOT (SELECT doc_id, """ + ", ".join(FEATURES) + """ FROM f) ON """ + ", ".join(FEATURES) + """ INTO NAME feature VALUE value)
SELECT doc_id, if(doc_id % 5 = 0, 'test', 'train') AS split, feature, value FROM long WHERE feature IN (SELECT feature FROM v WHERE variance > 500)
""")
def selected_features(spark, sf):
    """A selection learnt from scores, applied to the training and the test rows alike."""
    d = doc_features(spark, sf, labelled=False).withColumn("split", F.when(F.col("doc_id") % 5 == 0, "test").otherwise("train"))
    scores = S.variance_filter(d, FEATURES, 500)
    parts = C.apply_selection([d.filter("split = 'train'"), d.filter("split = 'test'")], scores, ["doc_id", "split"])
    both = parts[0].unionByName(parts[1])
    return both.unpivot(["doc_id", "split"], [c for c in both.columns if c in FEATURES], "feature", "value").filter("value IS NOT NULL")


@query("parts_sum_violations", oracle="""
SELECT count(*) FILTER (a + n + r <> total) AS n_violations, count(*) AS n_rows
FROM (SELECT count(*) FILTER (l_returnflag = 'A') AS a, count(*) FILTER (l_returnflag = 'N') AS n, count(*) FILTER (l_returnflag = 'R') AS r,
             count(*) AS total FROM lineitem GROUP BY l_orderkey)
""")
def parts_sum_violations(spark, sf):
    """Rows on which the parts don't add up to the total (and the assertion itself)."""
    from ordertide.plans.recovery import check_parts_sum
    n = lambda f: F.count_if(F.col("l_returnflag") == f)
    per = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(n("A").alias("a"), n("N").alias("n"), n("R").alias("r"), F.count(F.lit(1)).alias("total"))
    check_parts_sum(per, ["a", "n", "r"], "total")
    return per.agg(F.count_if(F.col("a") + F.col("n") + F.col("r") != F.col("total")).alias("n_violations"), F.count(F.lit(1)).alias("n_rows"))
