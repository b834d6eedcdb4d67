"""Column selection and typing, row flags, and derived columns.

What depends on the data (which columns are binary, mostly null, nullable) is read in one
aggregation; everything else is a projection or a filter.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordertide.operators.profile import NUMERIC

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def status_or_positive(df: DataFrame, status: str, value, label: str) -> DataFrame:
    """The rows of one status and, whatever their status, the positives."""
    return df.filter((F.col(status) == value) | (F.col(label) == 1))


def keep_existing(df: DataFrame, wanted: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Select the wanted columns that exist; return the missing ones."""
    return df.select(*[c for c in wanted if c in df.columns]), [c for c in wanted if c not in df.columns]


def columns_by_affix(df: DataFrame, prefix: str = "", suffix: str = "") -> list[str]:
    """Column names with a given prefix and / or suffix."""
    return [c for c in df.columns if c.startswith(prefix) and c.endswith(suffix)]


def null_shares(df: DataFrame) -> dict[str, float]:
    """Share of nulls of each column, one pass (0 of an empty table)."""
    r = df.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(F.col(c).isNull()).alias(f"c{i}") for i, c in enumerate(df.columns)]).first()
    return {c: r[f"c{i}"] / r["n"] if r["n"] else 0.0 for i, c in enumerate(df.columns)}


def drop_high_null(df: DataFrame, threshold: float = 0.9) -> DataFrame:
    """Drop columns whose null share is at least ``threshold``."""
    shares = null_shares(df)
    return df.drop(*[c for c in df.columns if shares[c] >= threshold])


def complete_rows(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Rows without a null (or NaN) in ``cols``, by default in any column."""
    return df.dropna(how="any", subset=list(cols) if cols else None)


def binary_columns(df: DataFrame, cols: Sequence[str] | None = None) -> list[str]:
    """Number columns whose values are all 0 or 1 (one pass); one without values isn't."""
    cols = [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC) and (cols is None or f.name in cols)]
    if not cols:
        return []
    r = df.agg(*[e for i, c in enumerate(cols) for e in (F.count(c).alias(f"n{i}"), F.count_if(~F.col(c).isin(0, 1)).alias(f"o{i}"))]).first()
    return [c for i, c in enumerate(cols) if r[f"n{i}"] and not r[f"o{i}"]]


def outcome(label: Column, score: Column, threshold: float) -> Column:
    """TP, FN, FP or TN of a row at a score threshold."""
    hit = score >= threshold
    return F.when(label == 1, F.when(hit, "TP").otherwise("FN")).otherwise(F.when(hit, "FP").otherwise("TN"))


def feature_histogram(df: DataFrame, feature: str, group: Column, bins: int = 20, name: str = "outcome") -> DataFrame:
    """Counts of a feature per equal-width bin (over its own range) and group; the last
    bin holds the maximum."""
    lo, hi = df.agg(F.min(feature), F.max(feature)).first()
    if lo is None:
        return df.limit(0).select(F.lit(0).alias("bin"), group.alias(name), F.lit(0).cast("long").alias("n"))
    width = (hi - lo) / bins or 1.0
    b = F.least(F.floor((F.col(feature) - F.lit(lo)) / F.lit(width)), F.lit(bins - 1)).cast("int")
    return df.filter(F.col(feature).isNotNull()).groupBy(b.alias("bin"), group.alias(name)).agg(F.count(F.lit(1)).alias("n"))


def any_of(cols: Sequence[str]) -> Column:
    """1 if one of the flags is positive, else 0 (null flags count as 0)."""
    return F.greatest(F.lit(0), *[F.coalesce((F.col(c) > 0).cast("int"), F.lit(0)) for c in cols])


def top_flags(df: DataFrame, flags: Sequence[str], n: int, other: str, apart: Sequence[str] = ()) -> DataFrame:
    """The ``n`` flags with the largest sums stay (ties by name), the rest become one flag
    ``other``; flags in ``apart`` (that of the null level) are neither ranked nor merged."""
    ranked = [f for f in flags if f not in apart]
    sums = df.agg(*[F.sum(F.col(f).cast("long")).alias(f"s{i}") for i, f in enumerate(ranked)]).first()
    order = sorted(ranked, key=lambda f: (-(sums[f"s{ranked.index(f)}"] or 0), f))
    rest = [f for f in ranked if f in order[n:]]
    return df.withColumn(other, any_of(rest) if rest else F.lit(0)).drop(*rest)


def merge_rare_flags(df: DataFrame, plan: DataFrame, name: str = "any_rare_flag") -> DataFrame:
    """The flags that ``prep.rare_flag_plan`` says to merge become one; merged and dropped ones go."""
    action = {r["flag"]: r["action"] for r in plan.collect()}          # one row per flag
    merge = [f for f, a in action.items() if a == "merge"]
    return df.withColumn(name, any_of(merge) if merge else F.lit(0)).drop(*[f for f, a in action.items() if a != "keep"])


def group_totals(df: DataFrame, cols: Sequence[str], prefix: str) -> DataFrame:
    """I16: over a group of columns the total, the number above zero, and whether there is one."""
    total = reduce(lambda a, c: a + F.coalesce(F.col(c), F.lit(0)), cols, F.lit(0))
    above = reduce(lambda a, c: a + F.coalesce((F.col(c) > 0).cast("int"), F.lit(0)), cols, F.lit(0))
    return df.withColumns({f"{prefix}_total": total, f"{prefix}_count": above, f"has_{prefix}": any_of(cols)})


def lead_times(df: DataFrame, elapsed: str, remaining: str, total: str, slack: str) -> DataFrame:
    """Whole lead time (elapsed + remaining) and the slack that is left, if both columns exist."""
    out = df
    if elapsed in df.columns and remaining in df.columns:
        out = out.withColumn(total, F.col(elapsed) + F.col(remaining))
    return out.withColumn(slack, F.col(remaining)) if remaining in df.columns else out


def standard_types(df: DataFrame) -> DataFrame:
    """Flags as integers, whole numbers as bigint (as double if some are null, so that gaps
    are NaN-able), other numbers as double; further types stay."""
    shares = null_shares(df)

    def cast(f: T.StructField) -> Column:
        c = F.col(f.name)
        if isinstance(f.dataType, T.BooleanType):
            return c.cast("int").alias(f.name)
        if isinstance(f.dataType, _INTEGRAL):
            return c.cast("double" if shares[f.name] else "bigint").alias(f.name)
        return c.cast("double").alias(f.name) if isinstance(f.dataType, NUMERIC) else c

    return df.select(*[cast(f) for f in df.schema.fields])


def column_roles(df: DataFrame, ids: Sequence[str] = (), id_suffixes: Sequence[str] = ("_id", "_no", "key")) -> DataFrame:
    """(column_name, role): id, date, numeric, categorical or other, by name and type."""
    def role(f: T.StructField) -> str:
        if f.name in ids or f.name.endswith(tuple(id_suffixes)):
            return "id"
        if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            return "date"
        if isinstance(f.dataType, (*NUMERIC, T.BooleanType)):
            return "numeric"
        return "categorical" if isinstance(f.dataType, T.StringType) else "other"

    return df.sparkSession.createDataFrame([(f.name, role(f)) for f in df.schema.fields], "column_name string, role string")


def modelling_columns(df: DataFrame, **kw) -> DataFrame:
    """The numeric and categorical columns; ids and dates go."""
    roles = {r["column_name"]: r["role"] for r in column_roles(df, **kw).collect()}
    return df.select(*[c for c in df.columns if roles[c] in ("numeric", "categorical")])


def apply_selection(frames: Sequence[DataFrame], scores: DataFrame, keep: Sequence[str], flag: str = "selected") -> list[DataFrame]:
    """Every frame reduced to ``keep`` and the features that ``scores`` (feature, flag) selects."""
    chosen = {r["feature"] for r in scores.filter(F.col(flag)).collect()}          # one row per feature
    return [f.select(*keep, *[c for c in f.columns if c in chosen and c not in keep]) for f in frames]
