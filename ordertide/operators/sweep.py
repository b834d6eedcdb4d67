"""Look-back counts by a sweep line.

What is valid on a span of days adds 1 on its first day and takes 1 off after its last;
the running sum of these steps is the number valid on each day.  So a look-back of a
month costs two rows per event, not one per day that it can be seen from, and distinct
counts cost no more: of a key that recurs within the look-back, each span ends where
the next one begins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def last_day_seen(date: Column, months: int = 1) -> Column:
    """The last day ``d`` with ``date >= add_months(d, -months)``: a month's last days all look
    back to the last day of a shorter month."""
    ahead = F.add_months(date, months)
    return F.when(date == F.last_day(date), F.last_day(ahead)).otherwise(ahead)


def _steps(rows: DataFrame, by: Sequence[str], first: str, after: str, sums: Sequence[str]) -> DataFrame:
    """(by, __day, sums): the steps of rows that count from ``first`` until before ``after``."""
    up = rows.select(*by, F.col(first).alias("__day"), *sums)
    down = rows.select(*by, F.col(after).alias("__day"), *[(-F.col(c)).alias(c) for c in sums])
    return up.unionByName(down)


def _swept(spine: DataFrame, steps: DataFrame, by: Sequence[str], spine_date: str, sums: Sequence[str], rows: str, one_row: bool = False) -> DataFrame:
    """``spine`` plus the running sums on its days; null where nothing (no ``rows``) is valid.

    Steps and spine days are first summed per key and day, so that the window of a key
    has at most one row a day.  With ``one_row`` a spine of one row per key and day goes through
    with its columns and isn't read again."""
    own = [c for c in spine.columns if c not in (*by, spine_date)] if one_row else []
    days = spine.select(*by, F.col(spine_date).alias("__day"), *own, F.lit(1).alias("__spine"))
    both = steps.unionByName(days, allowMissingColumns=True)
    both = both.groupBy(*by, "__day").agg(*[F.sum(c).alias(c) for c in sums], *[F.max(c).alias(c) for c in own], F.max("__spine").alias("__spine"))
    w = Window.partitionBy(*by).orderBy("__day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = both.withColumns({c: F.sum(c).over(w) for c in sums}).filter("__spine = 1")
    run = run.select(*by, F.col("__day").alias(spine_date), *own, *[F.when(F.col(rows) > 0, F.col(c)).alias(c) for c in sums if c != "__rows"])
    if one_row:
        return run
    return spine.join(run, [*by, spine_date], "left").select(*spine.columns, *[c for c in sums if c != "__rows"])


def lookback_sums(spine: DataFrame, daily: DataFrame, by: Sequence[str], spine_date: str, day: str,
                  sums: Sequence[str], months: int = 1) -> DataFrame:
    """Per spine day ``d`` the sums of ``daily`` over ``[d - months, d - 1 day]``, null without a
    row there.  ``daily`` has per-day totals (or raw rows; they are summed per key and
    day first).  Keys and days may not be null."""
    rows = daily.withColumns({"__first": F.date_add(day, 1), "__after": F.date_add(last_day_seen(F.col(day), months), 1),
                              "__rows": F.lit(1)})
    own = [*sums, "__rows"]
    return _swept(spine, _steps(rows, by, "__first", "__after", own), by, spine_date, own, "__rows")


def lookback_distinct(spine: DataFrame, events: DataFrame, by: Sequence[str], spine_date: str, event_date: str,
                      key: Sequence[str], name: str, counts: dict[str, Column] | None = None, months: int = 1, one_row: bool = False) -> DataFrame:
    """Per spine day ``d``: the distinct ``key`` values of the events in ``[d - months, d - 1 day]``
    as ``name``, and per entry of ``counts`` the number of events that meet it; null
    without an event there.  ``one_row``: as in ``_swept``."""
    flags = {n: F.count_if(c) for n, c in (counts or {}).items()}
    seen = events.groupBy(*by, *key, F.col(event_date).alias("__e")).agg(F.count(F.lit(1)).alias("__n"), *[e.alias(n) for n, e in flags.items()])
    seen = seen.filter("__e IS NOT NULL")
    again = F.lead("__first").over(Window.partitionBy(*by, *key).orderBy("__e"))
    once = seen.withColumns({"__first": F.date_add("__e", 1), "__after": F.date_add(last_day_seen(F.col("__e"), months), 1)})
    once = once.withColumn("__until", F.least("__after", again))
    # a row's steps come out of it together, so that the events are read once
    step = lambda day, n, sign: F.struct(F.col(day).alias("__day"), F.lit(n).cast("long").alias(name), *[(sign * F.col(c)).alias(c) for c in flags])
    steps = [step("__first", 1, F.lit(1)), step("__until", -1, F.lit(0)), *([step("__after", 0, F.lit(-1))] if flags else [])]
    steps = once.select(*by, F.explode(F.array(*steps)).alias("__s")).select(*by, "__s.*")
    return _swept(spine, steps, by, spine_date, [name, *flags], name, one_row)
