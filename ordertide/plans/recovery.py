"""K13 recovery success analysis (D9-D20) over an attempts table.

Every table is a grouped aggregate; shares of a total divide by a scalar
total (no join, no unpartitioned window over the grouped rows).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_share(df: DataFrame, count_col: str, name: str, places: int = 4) -> DataFrame:
    """Add ``name`` = 100 * count / total.

    The total is one scalar read from a one-row aggregate (partial sums per
    task), then used as a literal: no join and no unpartitioned window.
    """
    total = df.agg(F.sum(count_col)).first()[0]
    return df.withColumn(name, F.round(F.try_divide(100.0 * F.col(count_col), F.lit(total)), places))


def sequence_attempts(attempts: DataFrame, delivery: Sequence[str], ts: str, success: Column,
                      tiebreak: Sequence[str] = (), bucket_seconds: int = 3600) -> DataFrame:
    """Attempt number per delivery, success flags and ever / never flags (SR:70-76).

    The number is an exact rank by (ts, tiebreak) within the delivery, built
    from per-(delivery, hour) counts (``rank_by_buckets``), so a delivery
    holding a third of all attempts is still ranked by many tasks; the
    ever-successful flag is a per-delivery aggregate joined back.
    """
    from ordertide.operators.prep import rank_by_buckets
    a = attempts.withColumn("successful_AR", success.cast("int"))
    a = rank_by_buckets(a, F.floor(F.unix_timestamp(ts) / bucket_seconds), [ts, *tiebreak], delivery,
                        "ar_attempt_seq").withColumn("ar_attempt_seq", F.col("ar_attempt_seq").cast("bigint"))
    ever = a.groupBy(*delivery).agg(F.max("successful_AR").alias("ever_successful"))
    a = a.join(ever, list(delivery)).withColumn("unsuccessful_AR", 1 - F.col("successful_AR"))
    return a.withColumn("never_successful", 1 - F.col("ever_successful"))


def delivery_rollup(a: DataFrame, delivery: Sequence[str], country: str) -> DataFrame:
    """Per delivery - attempts, successes, first country, ever / never flags."""
    return a.groupBy(*delivery).agg(
        F.count(F.lit(1)).alias("n_attempts"),
        F.sum("successful_AR").alias("n_successful"),
        F.min(country).alias(country),
        F.max("ever_successful").alias("ever_successful"),
        F.max("never_successful").alias("never_successful"),
        F.max(F.when(F.col("ar_attempt_seq") == 1, F.col("successful_AR"))).alias("first_attempt_success"),
        F.min(F.when(F.col("successful_AR") == 1, F.col("ar_attempt_seq"))).alias("first_success_attempt"),
    )


def first_success_distribution(a: DataFrame, delivery: Sequence[str]) -> DataFrame:
    """Deliveries by the attempt number of their first success, with %."""
    first = (a.filter(F.col("successful_AR") == 1).groupBy(*delivery)
             .agg(F.min("ar_attempt_seq").alias("first_success_attempt")))
    dist = first.groupBy("first_success_attempt").agg(F.count(F.lit(1)).alias("n_deliveries"))
    return with_share(dist, "n_deliveries", "pct_deliveries")


def attempt_breakdown(a: DataFrame) -> DataFrame:
    """Per attempt number - attempts, successes, success rate."""
    return a.groupBy("ar_attempt_seq").agg(
        F.count(F.lit(1)).alias("n_attempts"),
        F.sum("successful_AR").alias("n_successful"),
        F.round(100 * F.avg("successful_AR"), 4).alias("success_rate_pct"))


def country_breakdown(a: DataFrame, delivery: Sequence[str], country: str) -> DataFrame:
    """Per country - deliveries, those ever and never successful, and the success rate over deliveries."""
    per = a.groupBy(*delivery).agg(F.min(country).alias(country), F.max("successful_AR").alias("ok"))
    return per.groupBy(country).agg(
        F.count(F.lit(1)).alias("n_deliveries"), F.sum("ok").cast("long").alias("ever_successful"),
        F.sum(1 - F.col("ok")).cast("long").alias("never_successful"),
        F.round(100 * F.avg("ok"), 4).alias("success_rate_pct")).orderBy(F.desc("n_deliveries"), country)


def recovery_after_failure(a: DataFrame, delivery: Sequence[str]) -> DataFrame:
    """Among deliveries whose first attempt failed, the share later recovered."""
    failed_first = a.filter((F.col("ar_attempt_seq") == 1) & (F.col("successful_AR") == 0)).select(*delivery)
    later = a.join(failed_first, list(delivery), "left_semi")
    per = later.groupBy(*delivery).agg(F.max("successful_AR").alias("recovered"))
    return per.agg(F.count(F.lit(1)).alias("n_first_failed"),
                   F.sum("recovered").alias("n_recovered"),
                   F.round(F.try_divide(100.0 * F.sum("recovered"), F.count(F.lit(1))), 4)
                   .alias("recovery_rate_pct"))


def key_metrics(rollup: DataFrame) -> DataFrame:
    """D11 + D12 + D14 + D18: headline counts and shares as (metric, value) rows."""
    ever, n = F.sum("ever_successful"), F.count(F.lit(1))
    one = rollup.agg(
        n.cast("double").alias("total_deliveries"),
        ever.cast("double").alias("ever_successful"),
        F.sum("never_successful").cast("double").alias("never_successful"),
        F.round(100.0 * ever / n, 4).alias("ever_successful_pct"),
        F.sum("first_attempt_success").cast("double").alias("first_attempt_success"),
        F.round(100.0 * F.sum("first_attempt_success") / n, 4).alias("first_attempt_success_pct"),
        F.round(F.avg("first_success_attempt"), 4).alias("mean_attempts_to_success"),
        F.round(F.try_divide(100.0 * F.count_if(F.col("first_success_attempt") > 1), ever), 4)
        .alias("later_attempt_success_pct"),
        F.round(100.0 * F.sum("never_successful") / n, 4).alias("never_successful_pct"),
        # of the deliveries whose first attempt failed, those with a later success
        F.round(F.try_divide(100.0 * F.count_if((F.col("first_attempt_success") == 0) & (F.col("ever_successful") == 1)),
                             F.count_if(F.col("first_attempt_success") == 0)), 4).alias("recovery_after_first_failure_pct"),
    )
    return one.unpivot([], one.columns, "metric", "value")


def flag_consistency(a: DataFrame, delivery: Sequence[str], flags: Sequence[str]) -> DataFrame:
    """Per delivery the distinct values of flags that its rows carry, and whether each flag
    has but one (flags that are recorded per row; a flag derived per delivery can't differ)."""
    per = a.groupBy(*delivery).agg(*[F.count_distinct(f).alias(f"n_{f}") for f in flags])
    return per.withColumn("consistent", F.least(*[(F.col(f"n_{f}") <= 1).cast("int") for f in flags], F.lit(1)))


def check_parts_sum(df: DataFrame, parts: Sequence[str], total: str) -> None:
    """Raise when the parts do not add up to the total on some row."""
    bad = df.filter(sum(F.col(p) for p in parts) != F.col(total)).limit(1).count()
    if bad:
        raise AssertionError(f"{' + '.join(parts)} != {total}")
