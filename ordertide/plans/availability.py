"""K1 availability features and K2 imputed stock z-score.

K1 in the warehouse version derives six frames from the change log and joins
them back on (keys, time) and (keys, day).  Here every feature is a window
over one frame split by item and day, with halo and carry rows instead of
self-joins, so that an item with very many changes spreads over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordertide.functions.scalars import epoch_seconds
from ordertide.operators import halo
from ordertide.operators.relational import any_per_key
from ordertide.fixed import Z_ITEM_MEDIAN, Z_NEUTRAL, Z_OBSERVED, Z_UNIT_MEDIAN

DAY = 86_400


def availability_features(log: DataFrame, keys: Sequence[str], ts: str = "modify_date_time",
                          qty: str = "availability_qty", days: int = 28,
                          start: str | None = None) -> DataFrame:
    """Per change-log row: 28-day stock mean / variance, daily change rates,
    stockout / replenishment counts and days since the last one, and the
    estimated days until the next stockout.  Output keeps the smallest
    quantity per (keys, ts).

    Rows are split by (item, UTC day); nothing holds more of an item than a day of
    it, the same day ``days`` before, and its table of one row per day.  That
    table gives the daily rates and, as carry rows, what a day needs from
    before it: the last quantity, the latest stockout and replenishment, and the
    sums over the days in between (``operators.halo``).
    """
    keys = list(keys)
    rows = log.withColumn("__b", F.floor(epoch_seconds(F.col(ts)) / F.lit(DAY)).cast("long")).repartition(*keys, "__b")
    rows = any_per_key(rows, [*keys, "__b", ts, qty])
    q = F.col(qty)

    by_day = Window.partitionBy(*keys).orderBy("__b")
    table = rows.groupBy(*keys, "__b").agg(F.min(qty).alias("__min"))
    rate = F.try_divide(F.col("__min") - F.lag("__min").over(by_day), F.col("__b") - F.lag("__b").over(by_day))
    table = table.withColumn("current_daily_stock_change_rate", rate)
    rate, month = F.col("current_daily_stock_change_rate"), by_day.rangeBetween(-days, 0)
    table = table.select(*keys, "__b", rate, F.avg(rate).over(month).alias("average_daily_stock_change_rate_replenishment"),
                         # average over the non-positive days only, reported on those days
                         F.when(rate <= 0, F.avg(F.when(rate <= 0, rate)).over(month)).alias("average_daily_stock_change_rate"))
    f = halo.previous_and_latest(rows, keys, F.col("__b"), [ts, qty], {"__lag": qty, "__lag_ts": ts}, carried=table)

    f = f.withColumns({
        "stockout_dummy": F.when((q == 0) & (F.col("__lag") > 0), 1).otherwise(0),
        "replenishment_dummy": F.when(q > F.col("__lag"), 1).otherwise(0),
    }).withColumns({
        "__o": F.pmod(epoch_seconds(F.col(ts)), F.lit(DAY)).cast("long"), "__one": F.when(q.isNotNull(), F.lit(1).cast("long")),
        "__square": q * q, "__so": F.when(F.col("stockout_dummy") == 1, F.col(ts)),
        "__rep": F.when(F.col("replenishment_dummy") == 1, F.col(ts)),
    })
    f = halo.moving_sums(f, keys, "__b", "__o", [qty, "__one", "__square", "stockout_dummy", "replenishment_dummy"], days,
                         latest=["__so", "__rep"], keep=[c for c in f.columns if c not in ("__so", "__rep", "__one", "__square")], time=ts)
    n, total = F.col("sum___one"), F.col(f"sum_{qty}")
    date = F.date_from_unix_date(F.col("__b").cast("int"))
    f = f.withColumns({
        "modify_date": date,
        "stockout_dummy": F.col("stockout_dummy").cast("int"), "replenishment_dummy": F.col("replenishment_dummy").cast("int"),
        "average_stock_4_weeks": F.when(n > 0, total / n),
        "stock_variance_4_weeks": F.when(n > 1, F.greatest(F.col("sum___square") - total * total / n, F.lit(0.0)) / (n - 1)),
        "stockout_count_28_days": F.col("sum_stockout_dummy"),
        "replenishment_count_28_days": F.col("sum_replenishment_dummy"),
        "days_since_last_stockout": _days_since(date, F.col("latest___so")),
        "days_since_last_replenishment": _days_since(date, F.col("latest___rep")),
        "estimated_days_till_next_stockout": estimated_days_to_stockout(
            q, F.col("current_daily_stock_change_rate"), F.col("average_daily_stock_change_rate"),
            F.col("average_daily_stock_change_rate_replenishment")),
    })
    if start is not None:
        f = f.filter(F.col(ts) >= F.lit(start).cast(log.schema[ts].dataType))
    # smallest quantity per (keys, ts): the first row of each timestamp in row order
    f = f.filter(F.col("__lag_ts").isNull() | (F.col("__lag_ts") != F.col(ts)))
    return f.drop(*[c for c in f.columns if c.startswith(("__", "sum_", "latest_"))])


def _days_since(date: Column, ts: Column) -> Column:
    return F.datediff(date, F.date_from_unix_date(F.floor(epoch_seconds(ts) / F.lit(DAY)).cast("int")))


def estimated_days_to_stockout(qty: Column, current: Column, avg_nonpos: Column,
                               avg_all: Column) -> Column:
    """0 when empty, else floor(qty / |rate|) over three rates in turn."""
    return (F.when(qty == 0, F.lit(0.0))
            .when((F.abs(avg_nonpos) == 0) & (F.abs(current) != 0), F.floor(qty / F.abs(current)))
            .when(F.abs(avg_nonpos) != 0, F.floor(qty / F.abs(avg_nonpos)))
            .when(avg_nonpos.isNull() & (avg_all != 0), F.floor(qty / F.abs(avg_all)))
            .cast("double"))


def stock_zscore(log: DataFrame, unit_keys: Sequence[str], item: str, ts: str = "modify_date_time",
                 qty: str = "availability_qty", n_prior: int = 30, min_days: int = 20,
                 min_valid: int = 5) -> DataFrame:
    """K2: end-of-day stock, z-score against the previous ``n_prior`` days,
    imputed by the item median (>= ``min_valid`` scores), then the unit median,
    then 0, with the provenance label and below-average flags.

    The 30 prior rows come from blocks of an item's days with a halo
    (``halo.prior_rows_stats``).  Item and unit medians come from
    partial-aggregating ``percentile_approx`` (mergeable sketches), joined back;
    by then an item has at most one row a day."""
    keys = [*unit_keys, item]
    daily = (log.groupBy(*keys, F.to_date(ts).alias("snapshot_date"))
             .agg(F.max(ts).alias("last_update_time"),
                  F.max_by(qty, ts).alias("current_availability")))
    s = halo.prior_rows_stats(daily, keys, "snapshot_date", "current_availability",
                              F.floor(F.unix_date("snapshot_date") / 64), n_prior, prefix="__")
    s = s.withColumnsRenamed({"__avg": "avg_30d_availability", "__stddev": "stddev_30d_availability", "__n": "n_days_in_window"})
    valid = (F.col("stddev_30d_availability") > 0) & (F.col("n_days_in_window") >= min_days)
    z = F.when(valid, (F.col("current_availability") - F.col("avg_30d_availability"))
               / F.col("stddev_30d_availability"))
    s = s.withColumn("stock_z_score_original", z)
    # one pass to the medians of the items and, from the scores again, of the units
    item = s.groupBy(*keys).agg(F.percentile_approx("stock_z_score_original", 0.5).alias("median_item_z_score"),
                                F.count_if(valid).alias("n_valid_z_scores"))
    unit = (s.groupBy(*unit_keys)
            .agg(F.percentile_approx("stock_z_score_original", 0.5).alias("median_bu_z_score")))
    s = _null_safe_left_join(s, item, keys)
    s = s.join(unit, list(unit_keys), "left")
    item_ok = F.col("n_valid_z_scores") >= min_valid
    imputed = F.coalesce(F.col("stock_z_score_original"),
                         F.when(item_ok, F.col("median_item_z_score")),
                         F.col("median_bu_z_score"), F.lit(0.0))
    method = (F.when(valid, Z_OBSERVED).when(item_ok, Z_ITEM_MEDIAN)
              .when(F.col("median_bu_z_score").isNotNull(), Z_UNIT_MEDIAN)
              .otherwise(Z_NEUTRAL))
    s = s.withColumns({
        "stock_z_score_imputed": imputed,
        "imputation_method": method,
        "stock_z_score_imputed_flag": F.when(valid, 0).otherwise(1),
    })
    return s.withColumns({
        "below_avg_imputed": F.when(F.col("stock_z_score_imputed") < 0, 1).otherwise(0),
        "stock_1sd_below_imputed": F.when(F.col("stock_z_score_imputed") < -1, 1).otherwise(0),
        "below_30d_avg_original": F.when(
            F.col("current_availability") < F.col("avg_30d_availability"), 1).otherwise(0),
    }).drop("median_item_z_score", "n_valid_z_scores", "median_bu_z_score", "last_update_time")


def _null_safe_left_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join in which null keys are equal, as in a grouping."""
    r = right.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    on = [F.col(k).eqNullSafe(F.col(f"__r_{k}")) for k in keys]
    return left.join(r, on, "left").drop(*[f"__r_{k}" for k in keys])
