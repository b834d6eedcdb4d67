"""

Each profile is one aggregation pass over the data that returns a small
table (one row per column or per pair of columns).  Only those small
results, never the data, reach the driver.

Quantiles are exact and interpolated, by distributed selection
(``operators.quantiles``).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordertide.operators.gram import pairwise_correlation
from ordertide.operators.quantiles import exact_quantiles

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC)]


def _long(one_row: DataFrame, names: Sequence[str], stats: Sequence[str], key: str = "column_name") -> DataFrame:
    """One-row frame with columns ``{name}__{stat}`` -> one row per name."""
    parts = [F.struct(F.lit(n).alias(key), *[F.col(f"{n}__{s}").alias(s) for s in stats]) for n in names]
    return one_row.select(F.explode(F.array(*parts)).alias("r")).select("r.*")


def missing_profile(df: DataFrame, cols: Sequence[str] | None = None, places: int = 4) -> DataFrame:
    """Per column the number and share (%) of NULL / NaN values, one pass."""
    cols = list(cols or df.columns)
    num = set(numeric_columns(df))
    def miss(c):
        m = F.col(c).isNull()
        if c in num:
            m = m | F.isnan(F.col(c).cast("double"))
        return m
    one = df.agg(F.count(F.lit(1)).alias("__n"),
                 *[F.count_if(miss(c)).alias(f"{c}__n_missing") for c in cols])
    one = one.select("*", *[F.round(F.try_divide(100.0 * F.col(f"{c}__n_missing"), F.col("__n")), places)
                            .alias(f"{c}__pct_missing") for c in cols])
    return _long(one, cols, ["n_missing", "pct_missing"])


def binary_prevalence(df: DataFrame, cols: Sequence[str], places: int = 4) -> DataFrame:
    """Mean, share in % and count of ones of 0/1 columns."""
    one = df.agg(*[e for c in cols for e in (
        F.round(F.avg(c), places + 2).alias(f"{c}__mean"),
        F.round(100 * F.avg(c), places).alias(f"{c}__pct_ones"),
        F.sum(F.col(c).cast("bigint")).alias(f"{c}__n_ones"),
        F.count(c).alias(f"{c}__n"))])
    return _long(one, cols, ["mean", "pct_ones", "n_ones", "n"])


def describe(df: DataFrame, cols: Sequence[str], probs: Sequence[float] = (0.01, 0.05, 0.5, 0.95, 0.99),
             places: int = 4) -> DataFrame:
    """Count, mean, sample std, min, max and interpolated percentiles per column.

    Percentiles are exact and distributed (``quantiles.exact_quantiles``); a column
    without values has null statistics."""
    aggs = []
    for c in cols:
        aggs += [F.count(c).alias(f"{c}__count"), F.round(F.avg(c), places).alias(f"{c}__mean"),
                 F.round(F.stddev_samp(c), places).alias(f"{c}__std"),
                 F.min(c).cast("double").alias(f"{c}__min"), F.max(c).cast("double").alias(f"{c}__max")]
    one = _long(df.agg(*aggs), cols, ["count", "mean", "std", "min", "max"])
    names = {float(p): f"p{int(round(p * 100)):02d}" for p in probs}
    q = exact_quantiles(df, cols, probs).groupBy("column_name").agg(
        *[F.round(F.max(F.when(F.col("p") == p, F.col("value"))), places).alias(n) for p, n in names.items()])
    return one.join(q, "column_name", "left")


def corr_matrix(df: DataFrame, cols: Sequence[str], places: int = 6) -> DataFrame:
    """Pairwise-complete Pearson correlation, long form (a, b, corr), from one Gramian."""
    r = pairwise_correlation(df, cols)
    rows = [(a, b, None if math.isnan(r[i, j]) else round(float(r[i, j]), places) + 0.0)
            for i, a in enumerate(cols) for j, b in enumerate(cols) if j >= i]
    return df.sparkSession.createDataFrame(rows, "col_a string, col_b string, corr double")


def value_counts(df: DataFrame, col: str, places: int = 4) -> DataFrame:
    """Count and share (%) of each value of ``col`` (NULL kept as a value)."""
    from ordertide.plans.recovery import with_share
    return with_share(df.groupBy(col).agg(F.count(F.lit(1)).alias("n")), "n", "share_pct", places)


def group_size_quartiles(counts: DataFrame, n_col: str = "n") -> DataFrame:
    """25th and 75th percentile of group sizes, interpolated (one row)."""
    q = exact_quantiles(counts, [n_col], [0.25, 0.75])
    return q.agg(F.max(F.when(F.col("p") == 0.25, F.col("value"))).alias("q25"),
                 F.max(F.when(F.col("p") == 0.75, F.col("value"))).alias("q75"))


def cardinality(df: DataFrame, cols: Sequence[str], approx: bool = False) -> DataFrame:
    """Number of distinct values per column."""
    f = F.approx_count_distinct if approx else F.count_distinct
    one = df.agg(*[f(c).alias(f"{c}__n_distinct") for c in cols])
    return _long(one, cols, ["n_distinct"])


# ---------------------------------------------------------------------------
# quality checks
# ---------------------------------------------------------------------------

def coercion_loss(df: DataFrame, cols: Sequence[str], to: str = "double") -> DataFrame:
    """Values lost by a numeric coercion (non-null before, null after)."""
    one = df.agg(*[F.count_if(F.col(c).isNotNull() & F.col(c).try_cast(to).isNull()).alias(f"{c}__n_lost")
                   for c in cols])
    return _long(one, cols, ["n_lost"])


def inf_to_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Replace +-inf by NULL."""
    return df.withColumns({c: F.when(F.abs(F.col(c)) == float("inf"), None).otherwise(F.col(c))
                           for c in cols})


def inf_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    one = df.agg(*[F.count_if(F.abs(F.col(c)) == float("inf")).alias(f"{c}__n_inf") for c in cols])
    return _long(one, cols, ["n_inf"])


def constant_columns(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Columns with at most one distinct non-null value."""
    cols = list(cols or df.columns)
    return cardinality(df, cols).filter(F.col("n_distinct") <= 1)


def duplicate_columns(df: DataFrame, cols: Sequence[str], row_key: Sequence[str]) -> DataFrame:
    """Pairs of columns holding identical values on every row.

    One pass computes an order-free digest per column, bit_xor(xxhash64(key, c))
    (XOR cannot overflow, unlike a sum under ANSI mode);
    pairs with equal digests are confirmed exactly in a second pass with a
    NULL-safe equality count.  Returns (col_a, col_b) with col_a < col_b in
    the given order.
    """
    key = [F.col(k) for k in row_key]
    dig = df.agg(*[F.bit_xor(F.xxhash64(*key, F.col(c).cast("string"))).alias(c) for c in cols]).first()
    cand = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:] if dig[a] == dig[b]]
    spark = df.sparkSession
    schema = "col_a string, col_b string"
    if not cand:
        return spark.createDataFrame([], schema)
    conf = df.agg(F.count(F.lit(1)).alias("__n"),
                  *[F.count_if(F.col(a).eqNullSafe(F.col(b))).alias(f"{a}|{b}") for a, b in cand]).first()
    keep = [(a, b) for a, b in cand if conf[f"{a}|{b}"] == conf["__n"]]
    return spark.createDataFrame(keep, schema)


def quality_issues(df: DataFrame, cols: Sequence[str], null_share_drop: float = 90.0) -> DataFrame:
    """I27 + B22: one row per detected issue (column, issue, value)."""
    miss = missing_profile(df, cols)
    high_null = miss.filter(F.col("pct_missing") >= null_share_drop).select(
        "column_name", F.lit("high_null_share").alias("issue"), F.col("pct_missing").cast("double").alias("value"))
    some_null = miss.filter((F.col("n_missing") > 0) & (F.col("pct_missing") < null_share_drop)).select(
        "column_name", F.lit("has_nulls").alias("issue"), F.col("n_missing").cast("double").alias("value"))
    num = [c for c in cols if c in set(numeric_columns(df))]
    inf = inf_counts(df, num).filter(F.col("n_inf") > 0).select(
        "column_name", F.lit("infinite_values").alias("issue"), F.col("n_inf").cast("double").alias("value"))
    const = constant_columns(df, cols).select(
        "column_name", F.lit("constant").alias("issue"), F.col("n_distinct").cast("double").alias("value"))
    return high_null.unionByName(some_null).unionByName(inf).unionByName(const)


def assert_parts_sum(df: DataFrame, parts: Sequence[str], total: str) -> None:
    """D20 invariant: parts add up to the total on every row."""
    from ordertide.plans.recovery import check_parts_sum
    check_parts_sum(df, parts, total)


def null_share_among(df: DataFrame, cond: Column, cols: Sequence[str]) -> DataFrame:
    """Missing profile restricted to rows matching ``cond`` (e.g. positives)."""
    return missing_profile(df.filter(cond), cols)
