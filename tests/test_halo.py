"""Split frames against plain windows and brute force; a hot key spreads over the tasks."""

import datetime as dt
import random
import statistics

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ordertide.operators import halo, windows
from ordertide.plans.availability import availability_features, stock_zscore

START = dt.datetime(2024, 1, 1)


def log_rows(n=3000, days=150, seed=3):
    """(item, ts, qty): item 1 has a third of all rows; ties in time, null values and times, whole-second edges."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        item = 1 if i % 3 == 0 else rng.randint(2, 40)
        ts = START + dt.timedelta(days=rng.randrange(days), seconds=rng.choice([0, 0, 86_399, rng.randrange(86_400)]),
                                  microseconds=rng.choice([0, 0, 500_000]))
        out.append((item, ts, float(rng.choice([0, 0, 1, 2, 5, 9]))))
    out += [(None, START, 4.0), (None, START + dt.timedelta(days=3), 2.0), (7, None, 3.0), (7, None, 1.0)]
    return out


@pytest.fixture(scope="module")
def log(spark):
    return spark.createDataFrame(log_rows(), "item_id long, ts timestamp_ntz, qty double").withColumn(
        "v", F.when(F.pmod(F.hash("ts", "qty"), F.lit(7)) > 0, F.col("qty")))


def table(df, places=6):
    return sorted((tuple(round(v, places) if isinstance(v, float) else v for v in r) for r in df.collect()), key=str)


@pytest.mark.parametrize("blocks", [4, 28, 28 * 24])
def test_trailing_stats_equal_plain_frames(log, blocks):
    aggs = {"a": ("avg", "v"), "s": ("sum", "v"), "n": ("count", "v"), "x": ("var_samp", "v"), "y": ("stddev_pop", "v"), "q": ("avg", "qty")}
    plain = windows.trailing_stats(log, ["item_id"], "ts", aggs)
    split = halo.trailing_stats(log, ["item_id"], "ts", aggs, blocks=blocks)
    assert split.columns == plain.columns
    assert table(split) == table(plain)


def test_trailing_stats_by_day_equal_plain_frames(log):
    days = log.select("item_id", F.to_date("ts").alias("d"), "qty")
    aggs = {"a": ("avg", "qty"), "n": ("count", "qty")}
    assert table(halo.trailing_stats(days, ["item_id"], "d", aggs, unit="days")) == table(
        windows.trailing_stats(days, ["item_id"], "d", aggs, unit="days"))


def test_trailing_stats_of_large_values(spark):
    rows = [(1, START + dt.timedelta(hours=i), 1e9 + i % 5) for i in range(200)]
    df = spark.createDataFrame(rows, "k long, ts timestamp_ntz, v double")
    got = halo.trailing_stats(df, ["k"], "ts", {"x": ("var_samp", "v")}, days=2, pivot=1e9)
    assert table(got) == table(windows.trailing_stats(df, ["k"], "ts", {"x": ("var_samp", "v")}, days=2))


def test_only_sums_and_whole_blocks(log):
    with pytest.raises(ValueError):
        halo.trailing_stats(log, ["item_id"], "ts", {"m": ("max", "v")})
    with pytest.raises(ValueError):
        halo.trailing_stats(log, ["item_id"], "ts", {"m": ("sum", "v")}, blocks=11)


def test_empty_table(log):
    none = log.limit(0)
    assert halo.trailing_stats(none, ["item_id"], "ts", {"m": ("sum", "v")}).count() == 0
    assert halo.latest_flagged(none, ["item_id"], "ts", {"m": F.col("v") > 0}).count() == 0


def test_prior_rows_equal_plain_frame(log):
    days = log.filter("ts IS NOT NULL").groupBy("item_id", F.to_date("ts").alias("d")).agg(F.max("qty").alias("q"))
    block = F.floor(F.unix_date("d") / 16)
    w = Window.partitionBy("item_id").orderBy("d").rowsBetween(-30, -1)
    plain = days.withColumns({"avg": F.avg("q").over(w), "stddev": F.stddev_samp("q").over(w), "n": F.count(F.lit(1)).over(w)})
    for size in (30, 37, 512):
        assert table(halo.prior_rows_stats(days, ["item_id"], "d", "q", block, 30, size)) == table(plain)


def test_previous_and_latest_equal_plain_windows(log):
    df = log.filter("ts IS NOT NULL").dropDuplicates(["item_id", "ts", "qty"])
    day = F.unix_date(F.to_date("ts"))
    w = Window.partitionBy("item_id").orderBy("ts", "qty")
    peers = Window.partitionBy("item_id").orderBy("ts").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    plain = df.withColumns({"p": F.lag("qty").over(w), "z": F.max(F.when(F.col("qty") == 0, F.col("ts"))).over(peers)})
    got = halo.previous_and_latest(df, ["item_id"], day, ["ts", "qty"], {"p": "qty"}).drop("__b")
    got = halo.latest_flagged(got, ["item_id"], "ts", {"z": F.col("qty") == 0})
    assert table(got) == table(plain)


def rows_per_task(df):
    # the hash keeps every column, so that the windows run
    return sorted(r["n"] for r in df.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n"), F.max(F.xxhash64(*df.columns))).collect())


def test_a_hot_item_spreads_over_the_tasks(spark, log):
    """A third of all rows are of one item: no task holds over twice the median."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "12")
        df = log.filter("ts IS NOT NULL")
        plain = rows_per_task(windows.trailing_stats(df, ["item_id"], "ts", {"s": ("sum", "v")}))
        assert plain[-1] > 2 * statistics.median(plain)
        for split in (halo.trailing_stats(df, ["item_id"], "ts", {"s": ("sum", "v")}),
                      halo.latest_flagged(df, ["item_id"], "ts", {"z": F.col("qty") == 0}),
                      availability_features(df.select("item_id", F.col("ts").alias("modify_date_time"), F.col("qty").alias("availability_qty")), ["item_id"])):
            counts = rows_per_task(split)
            assert counts[-1] <= 2 * statistics.median(counts)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def brute_availability(rows):
    """Features of one item's rows (ts, qty), by loops."""
    rows = sorted(set(rows))
    sec = lambda t: int((t - START).total_seconds() // 1)
    flags = [(t, q, q == 0 and i > 0 and rows[i - 1][1] > 0, i > 0 and q > rows[i - 1][1]) for i, (t, q) in enumerate(rows)]
    lows = {}
    for t, q in rows:
        lows[t.date()] = min(q, lows.get(t.date(), q))
    days = sorted(lows)
    rates = {d: (lows[d] - lows[p]) / (d - p).days for p, d in zip(days, days[1:])}
    out = []
    for i, (t, q, so, rep) in enumerate(flags):
        if i and rows[i - 1][0] == t:
            continue
        frame = [f for f in flags if sec(t) - 28 * 86_400 <= sec(f[0]) <= sec(t)]
        qs = [f[1] for f in frame]
        rate = rates.get(t.date())
        near = [r for d, r in rates.items() if 0 <= (t.date() - d).days <= 28]
        falling = [r for r in near if r <= 0]
        last = {k: max((f[0] for f in flags if f[k] and f[0] <= t), default=None) for k in (2, 3)}
        out.append((t, q, round(statistics.mean(qs), 6), round(statistics.variance(qs), 6) if len(qs) > 1 else None,
                    None if rate is None else round(rate, 6), round(statistics.mean(near), 6) if near else None,
                    round(statistics.mean(falling), 6) if rate is not None and rate <= 0 else None, int(so), int(rep),
                    sum(f[2] for f in frame), sum(f[3] for f in frame),
                    *[None if last[k] is None else (t.date() - last[k].date()).days for k in (2, 3)]))
    return out


def test_availability_features_by_brute_force(spark, log):
    rows = [(i, t, q) for i, t, q in log_rows() if i in (1, 5, 9) and t is not None]
    df = spark.createDataFrame(rows, "item_id long, modify_date_time timestamp_ntz, availability_qty double")
    cols = ["modify_date_time", "availability_qty", "average_stock_4_weeks", "stock_variance_4_weeks", "current_daily_stock_change_rate",
            "average_daily_stock_change_rate_replenishment", "average_daily_stock_change_rate", "stockout_dummy", "replenishment_dummy",
            "stockout_count_28_days", "replenishment_count_28_days", "days_since_last_stockout", "days_since_last_replenishment"]
    got = availability_features(df, ["item_id"])
    for item in (1, 5, 9):
        want = brute_availability([(t, q) for i, t, q in rows if i == item])
        assert table(got.filter(F.col("item_id") == item).select(cols)) == sorted(want, key=str)


def test_zscore_keeps_null_units(spark, log):
    df = log.filter("ts IS NOT NULL").select(F.lit(None).cast("string").alias("unit"), "item_id", F.col("ts").alias("modify_date_time"),
                                             F.col("qty").alias("availability_qty"))
    out = stock_zscore(df, ["unit"], "item_id")
    days = df.select("item_id", F.to_date("modify_date_time")).distinct().count()
    assert out.count() == days
    assert out.filter("imputation_method = 'IMPUTED_ITEM_MEDIAN'").count() > 0
