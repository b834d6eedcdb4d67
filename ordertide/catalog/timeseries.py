"""Time-series family on the events change log: D5, E6, E9-E12, C15j, C16j, K1, K2."""

from __future__ import annotations

from pyspark.sql import functions as F

from ordertide.catalog import query, table
from ordertide.catalog._common import SQL_CHANGE_LOG, change_log
from ordertide.operators.relational import rolling_month_sum
from ordertide.operators import halo
from ordertide.plans.availability import availability_features, stock_zscore


def _round(df, cols, places=6):
    return df.withColumns({c: F.round(F.col(c), places) for c in cols})


_CL = f"WITH b AS ({SQL_CHANGE_LOG})"
_EPOCH = "CAST(floor(epoch(modify_date_time)) AS BIGINT)"


@query("snapshot_end_of_day", oracle=_CL + """
SELECT item_id, CAST(modify_date_time AS DATE) AS snapshot_date,
       max(modify_date_time) AS last_update_time,
       arg_max(availability_qty, modify_date_time) AS end_of_day_availability_qty
FROM b GROUP BY item_id, CAST(modify_date_time AS DATE)
""")
def snapshot_end_of_day(spark, sf):
    """Last value per group (ARRAY_AGG ... ORDER BY ts DESC LIMIT 1)."""
    b = change_log(spark, sf)
    return (b.groupBy("item_id", F.to_date("modify_date_time").alias("snapshot_date"))
            .agg(F.max("modify_date_time").alias("last_update_time"),
                 F.max_by("availability_qty", "modify_date_time").alias("end_of_day_availability_qty")))


@query("trailing_28d_stats", oracle=_CL + f"""
SELECT item_id, modify_date_time, availability_qty,
  round(avg(availability_qty) OVER w, 6) AS average_stock_4_weeks,
  round(var_samp(availability_qty) OVER w, 6) AS stock_variance_4_weeks,
  CAST(sum(availability_qty) OVER w AS DOUBLE) AS sum_stock_4_weeks
FROM b
WINDOW w AS (PARTITION BY item_id ORDER BY {_EPOCH} RANGE BETWEEN 2419200 PRECEDING AND CURRENT ROW)
""")
def trailing_28d_stats(spark, sf):
    """RANGE frame of 28 days in epoch seconds (AVG, sample VARIANCE, SUM), split by item and day."""
    b = change_log(spark, sf)
    s = halo.trailing_stats(b, ["item_id"], "modify_date_time", {
        "average_stock_4_weeks": ("avg", "availability_qty"),
        "stock_variance_4_weeks": ("var_samp", "availability_qty"),
        "sum_stock_4_weeks": ("sum", "availability_qty"),
    })
    return _round(s, ["average_stock_4_weeks", "stock_variance_4_weeks"])


_SQL_DAILY = _CL + """,
low AS (SELECT item_id, CAST(modify_date_time AS DATE) AS modify_date, min(availability_qty) AS lowest FROM b GROUP BY ALL),
step AS (SELECT x.item_id, x.modify_date, x.lowest, max(y.modify_date) AS day_before, arg_max(y.lowest, y.modify_date) AS low_before,
                date_diff('day', max(y.modify_date), x.modify_date) AS days, x.lowest - arg_max(y.lowest, y.modify_date) AS change
         FROM low x LEFT JOIN low y ON y.item_id = x.item_id AND y.modify_date < x.modify_date
         GROUP BY x.item_id, x.modify_date, x.lowest)
"""


def _daily(spark, sf):
    from pyspark.sql import Window
    b = change_log(spark, sf)
    d = (b.groupBy("item_id", F.to_date("modify_date_time").alias("modify_date"))
         .agg(F.min("availability_qty").alias("min_availability_qty")))
    w = Window.partitionBy("item_id").orderBy("modify_date")
    d = d.withColumns({"lag_availability_qty": F.lag("min_availability_qty").over(w),
                       "lag_modify_date": F.lag("modify_date").over(w)})
    diff = F.datediff("modify_date", "lag_modify_date")
    return d.withColumns({
        "date_difference": diff.cast("bigint"),
        "availability_difference": F.col("min_availability_qty") - F.col("lag_availability_qty"),
        "current_daily_stock_change_rate": F.try_divide(
            F.col("min_availability_qty") - F.col("lag_availability_qty"), diff),
    })


@query("daily_change_rate", oracle=_SQL_DAILY + """
SELECT item_id, modify_date, lowest AS min_availability_qty, low_before AS lag_availability_qty, day_before AS lag_modify_date,
       days AS date_difference, change AS availability_difference, round(change / days, 6) AS current_daily_stock_change_rate
FROM step
""")
def daily_change_rate(spark, sf):
    """E6 + D1: daily minimum, LAG of value and date, change per day."""
    return _round(_daily(spark, sf), ["current_daily_stock_change_rate"])


@query("trailing_28d_rate", oracle=_SQL_DAILY + """
SELECT x.item_id, x.modify_date, round(x.change / x.days, 6) AS current_daily_stock_change_rate,
       round(avg(y.change / y.days), 6) AS average_daily_stock_change_rate_replenishment,
       CASE WHEN x.change <= 0 THEN round(avg(y.change / y.days) FILTER (y.change <= 0), 6) END AS average_daily_stock_change_rate
FROM step x JOIN step y ON y.item_id = x.item_id AND y.modify_date BETWEEN x.modify_date - 28 AND x.modify_date
GROUP BY x.item_id, x.modify_date, x.change, x.days
""")
def trailing_28d_rate(spark, sf):
    """E10 + E11: 28-day RANGE over DATE; the filtered-subset average is a
    conditional average over the same frame (no filter + join back)."""
    # by day, an item has one row a day: its window is bounded by the length of the history
    from pyspark.sql import Window
    d = _daily(spark, sf)
    w = Window.partitionBy("item_id").orderBy(F.unix_date("modify_date")).rangeBetween(-28, 0)
    rate = F.col("current_daily_stock_change_rate")
    out = d.select("item_id", "modify_date", "current_daily_stock_change_rate",
                   F.avg(rate).over(w).alias("average_daily_stock_change_rate_replenishment"),
                   F.when(rate <= 0, F.avg(F.when(rate <= 0, rate)).over(w))
                   .alias("average_daily_stock_change_rate"))
    return _round(out, ["current_daily_stock_change_rate",
                        "average_daily_stock_change_rate_replenishment",
                        "average_daily_stock_change_rate"])


_K1_COLS = ["average_stock_4_weeks", "stock_variance_4_weeks", "current_daily_stock_change_rate",
            "average_daily_stock_change_rate_replenishment", "average_daily_stock_change_rate"]


# Written from the meaning of each feature: every row looks up its own frame, day or
# latest event by a correlated subquery or a self-join.
_SQL_K1 = _CL + """,
r AS (SELECT DISTINCT item_id, modify_date_time AS t, availability_qty AS q, CAST(modify_date_time AS DATE) AS day,
             CAST(floor(epoch(modify_date_time)) AS BIGINT) AS s FROM b),
prev AS (SELECT x.item_id, x.t, x.q, max(ROW(y.t, y.q)) AS before
         FROM r x LEFT JOIN r y ON y.item_id = x.item_id AND (y.t, y.q) < (x.t, x.q) GROUP BY x.item_id, x.t, x.q),
e AS (SELECT r.*, r.q = 0 AND coalesce(p.before[2] > 0, FALSE) AS out_of_stock, coalesce(r.q > p.before[2], FALSE) AS filled
      FROM r JOIN prev p USING (item_id, t, q)),
low AS (SELECT item_id, day, min(q) AS lowest FROM r GROUP BY item_id, day),
speed AS (SELECT x.item_id, x.day, (x.lowest - arg_max(y.lowest, y.day)) / date_diff('day', max(y.day), x.day) AS rate
          FROM low x LEFT JOIN low y ON y.item_id = x.item_id AND y.day < x.day GROUP BY x.item_id, x.day, x.lowest),
pace AS (SELECT x.item_id, x.day, x.rate, avg(y.rate ORDER BY y.day) AS mean_all,
                CASE WHEN x.rate <= 0 THEN avg(y.rate ORDER BY y.day) FILTER (y.rate <= 0) END AS mean_falling
         FROM speed x JOIN speed y ON y.item_id = x.item_id AND y.day BETWEEN x.day - 28 AND x.day GROUP BY x.item_id, x.day, x.rate),
frame AS (SELECT x.item_id, x.t, x.q, avg(y.q) AS mean_q, var_samp(y.q) AS var_q,
                 count(*) FILTER (y.out_of_stock) AS n_out, count(*) FILTER (y.filled) AS n_filled
          FROM e x JOIN e y ON y.item_id = x.item_id AND y.s BETWEEN x.s - 28 * 86400 AND x.s GROUP BY x.item_id, x.t, x.q),
since AS (SELECT x.item_id, x.t, x.q, date_diff('day', max(y.day) FILTER (y.out_of_stock), x.day) AS d_out,
                 date_diff('day', max(y.day) FILTER (y.filled), x.day) AS d_filled
          FROM e x JOIN e y ON y.item_id = x.item_id AND y.t <= x.t GROUP BY x.item_id, x.t, x.q, x.day)
"""


@query("availability_features", oracle=_SQL_K1 + """
SELECT e.item_id, e.t AS modify_date_time, e.q AS availability_qty, e.day AS modify_date,
       round(f.mean_q, 6) AS average_stock_4_weeks, round(f.var_q, 6) AS stock_variance_4_weeks,
       round(p.rate, 6) AS current_daily_stock_change_rate,
       round(p.mean_all, 6) AS average_daily_stock_change_rate_replenishment,
       round(p.mean_falling, 6) AS average_daily_stock_change_rate,
       CAST(e.out_of_stock AS INT) AS stockout_dummy, CAST(e.filled AS INT) AS replenishment_dummy,
       f.n_out AS stockout_count_28_days, f.n_filled AS replenishment_count_28_days,
       s.d_out AS days_since_last_stockout, s.d_filled AS days_since_last_replenishment,
       CAST(if(e.q = 0, 0, floor(e.q / abs(CASE WHEN p.mean_falling <> 0 THEN p.mean_falling
                                                WHEN p.mean_falling = 0 AND p.rate <> 0 THEN p.rate
                                                WHEN p.mean_falling IS NULL AND p.mean_all <> 0 THEN p.mean_all END))) AS DOUBLE)
         AS estimated_days_till_next_stockout
FROM e JOIN frame f USING (item_id, t, q) JOIN since s USING (item_id, t, q) JOIN pace p USING (item_id, day)
WHERE NOT EXISTS (FROM e z WHERE z.item_id = e.item_id AND z.t = e.t AND z.q < e.q)
""")
def availability_features_q(spark, sf):
    """K1: all availability features on one frame, split by item and day."""
    f = availability_features(change_log(spark, sf), ["item_id"])
    f = f.withColumns({"days_since_last_stockout": F.col("days_since_last_stockout").cast("bigint"),
                       "days_since_last_replenishment": F.col("days_since_last_replenishment").cast("bigint"),
                       "stockout_count_28_days": F.col("stockout_count_28_days").cast("bigint"),
                       "replenishment_count_28_days": F.col("replenishment_count_28_days").cast("bigint")})
    return _round(f, _K1_COLS)


# --------------------------------------------------------------------------
# K2 z-score: units = the customer nation of the user, country = its region
# --------------------------------------------------------------------------

def _unit_log(spark, sf):
    b = change_log(spark, sf)
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = table(spark, sf, "region").select("r_regionkey", "r_name")
    dims = (n.join(r, n.n_regionkey == r.r_regionkey)
            .select("n_nationkey", F.col("n_name").alias("business_unit"),
                    F.col("r_name").alias("country_code")))
    return (b.join(c, b.item_id == c.c_custkey, "left")
            .join(F.broadcast(dims), F.col("c_nationkey") == dims.n_nationkey, "left")  # 25 rows
            .select("country_code", "business_unit", "item_id", "modify_date_time", "availability_qty"))


_SQL_UNIT_LOG = _CL + """,
u AS (SELECT rg.r_name AS country_code, n.n_name AS business_unit, b.item_id, b.modify_date_time, b.availability_qty
      FROM b LEFT JOIN customer c ON c.c_custkey = b.item_id
      LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
      LEFT JOIN region rg ON rg.r_regionkey = n.n_regionkey)
"""


# Written from the meaning: the last quantity of each day, numbered per item; the score
# of a day against its up to 30 predecessors by a self-join on these numbers.
@query("prior_30_rows_zscore", oracle=_SQL_UNIT_LOG + """,
day AS (SELECT country_code AS c, business_unit AS u, item_id AS i, CAST(modify_date_time AS DATE) AS d,
               arg_max(availability_qty, modify_date_time) AS stock FROM u GROUP BY ALL),
num AS (SELECT *, row_number() OVER (PARTITION BY c, u, i ORDER BY d) AS k FROM day),
ref AS (SELECT x.c, x.u, x.i, x.d, x.stock, avg(y.stock) AS mean, stddev_samp(y.stock) AS dev, count(y.stock) AS n
        FROM num x LEFT JOIN num y ON y.i = x.i AND y.c IS NOT DISTINCT FROM x.c AND y.u IS NOT DISTINCT FROM x.u
         AND y.k BETWEEN x.k - 30 AND x.k - 1 GROUP BY x.c, x.u, x.i, x.d, x.stock),
own AS (SELECT *, if(dev > 0 AND n >= 20, (stock - mean) / dev, NULL) AS z FROM ref),
mid AS (SELECT *, (SELECT quantile_disc(o.z, 0.5) FROM own o WHERE o.i = own.i AND o.c IS NOT DISTINCT FROM own.c
                    AND o.u IS NOT DISTINCT FROM own.u HAVING count(o.z) >= 5) AS of_item,
                  (SELECT quantile_disc(o.z, 0.5) FROM own o WHERE o.c = own.c AND o.u = own.u) AS of_unit FROM own),
fin AS (SELECT *, coalesce(z, of_item, of_unit, 0) AS zi FROM mid)
SELECT c AS country_code, u AS business_unit, i AS item_id, d AS snapshot_date, stock AS current_availability,
       round(mean, 6) AS avg_30d_availability, round(dev, 6) AS stddev_30d_availability, n AS n_days_in_window,
       round(z, 6) AS stock_z_score_original, round(zi, 6) AS stock_z_score_imputed,
       if(z IS NOT NULL, 'OBSERVED', if(of_item IS NOT NULL, 'IMPUTED_ITEM_MEDIAN',
          if(of_unit IS NOT NULL, 'IMPUTED_BU_MEDIAN', 'IMPUTED_NEUTRAL'))) AS imputation_method,
       CAST(z IS NULL AS INT) AS stock_z_score_imputed_flag, CAST(zi < 0 AS INT) AS below_avg_imputed,
       CAST(zi < -1 AS INT) AS stock_1sd_below_imputed, CAST(coalesce(stock < mean, FALSE) AS INT) AS below_30d_avg_original
FROM fin
""")
def prior_30_rows_zscore(spark, sf):
    """K2 (E12, D7, B17, B28): prior-30-row z-score with item / unit median imputation."""
    z = stock_zscore(_unit_log(spark, sf), ["country_code", "business_unit"], "item_id")
    return _round(z, ["avg_30d_availability", "stddev_30d_availability",
                      "stock_z_score_original", "stock_z_score_imputed"])


# --------------------------------------------------------------------------
# C15j + D3: orders per day, summed over the previous calendar month
# --------------------------------------------------------------------------

@query("rolling_month_orders", oracle="""
WITH d AS (SELECT o_orderpriority, CAST(o_orderdate AS DATE) AS order_date,
                  count(DISTINCT (o_orderkey, o_custkey)) AS n_orders
           FROM orders GROUP BY o_orderpriority, CAST(o_orderdate AS DATE))
SELECT o_orderpriority, order_date, n_orders,
       CAST(sum(n_orders) OVER (PARTITION BY o_orderpriority ORDER BY order_date
            RANGE BETWEEN INTERVAL 1 MONTH PRECEDING AND CURRENT ROW) AS BIGINT) AS n_orders_1m
FROM d
""")
def rolling_month_orders(spark, sf):
    o = table(spark, sf, "orders")
    # Group by the date *expression*, not a same-named column
    d = (o.groupBy("o_orderpriority", F.to_date("o_orderdate").alias("order_date"))
         .agg(F.count_distinct("o_orderkey", "o_custkey").alias("n_orders")))
    return rolling_month_sum(d, ["o_orderpriority"], "order_date", "n_orders", "n_orders_1m")


# --------------------------------------------------------------------------
# C16j + D4 + D33: calendar spine x previous-month look-back
# --------------------------------------------------------------------------

@query("lookback_month_deviations", oracle="""
WITH e AS (SELECT event_id, user_id, event_type, value, CAST(ts AS DATE) AS e_date FROM events),
span AS (SELECT user_id, min(e_date) AS d0, max(e_date) AS d1 FROM e GROUP BY user_id),
spine AS (SELECT user_id, CAST(unnest(generate_series(d0, d1, INTERVAL 1 DAY)) AS DATE) AS calendar_date FROM span),
j AS (SELECT s.user_id, s.calendar_date, e.event_id, e.event_type, e.value
      FROM spine s LEFT JOIN e ON e.user_id = s.user_id
       AND e.e_date >= s.calendar_date - INTERVAL 1 MONTH AND e.e_date <= s.calendar_date - INTERVAL 1 DAY)
SELECT user_id, calendar_date,
       count(DISTINCT event_id) AS n_events_1m,
       count(DISTINCT CASE WHEN event_type = 'error' THEN event_id END) AS n_deviations_1m,
       count(CASE WHEN event_type = 'error' AND value < 10 THEN 1 END) AS n_low_value_deviations_1m,
       round(100 * count(DISTINCT CASE WHEN event_type = 'error' THEN event_id END)
             / nullif(count(DISTINCT event_id), 0), 6) AS deviation_rate_1m_pct
FROM j GROUP BY user_id, calendar_date
""")
def lookback_month_deviations(spark, sf):
    """C16j + D4 + D33.  ``event_id`` is the key of ``events`` (one date per
    event), so its distinct count over the window is the sum of per-day
    distinct counts: events are pre-aggregated per (user, day) before the
    sweep."""
    from ordertide.operators.sweep import lookback_sums
    ev = table(spark, sf, "events").withColumn("e_date", F.to_date("ts"))
    spine = (ev.groupBy("user_id").agg(F.min("e_date").alias("d0"), F.max("e_date").alias("d1"))
             .select("user_id", F.explode(F.sequence("d0", "d1")).alias("calendar_date")))
    is_dev = F.col("event_type") == "error"
    daily = ev.groupBy("user_id", "e_date").agg(
        F.count_distinct("event_id").alias("n_events_1m"),
        F.count_distinct(F.when(is_dev, F.col("event_id"))).alias("n_deviations_1m"),
        F.count(F.when(is_dev & (F.col("value") < 10), 1)).alias("n_low_value_deviations_1m"))
    out = lookback_sums(spine, daily, ["user_id"], "calendar_date", "e_date",
                        ["n_events_1m", "n_deviations_1m", "n_low_value_deviations_1m"])
    out = out.fillna(0, ["n_events_1m", "n_deviations_1m", "n_low_value_deviations_1m"])
    rate = F.round(F.try_divide(100 * F.col("n_deviations_1m"), F.col("n_events_1m")), 6)
    return out.withColumn("deviation_rate_1m_pct", rate.cast("double"))
