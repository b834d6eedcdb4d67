"""Keyed relational operators: dedup, as-of / interval joins, look-backs.

Every function takes and returns DataFrames and is expressed with built-in
Spark SQL expressions, so Catalyst keeps filters and column pruning pushed to
the scans and the work stays inside whole-stage code generation.

Scale notes
-----------
* ``latest_per_key`` with a lone ``row_number() = 1`` is planned as
  ``WindowGroupLimit``: a *partial* top-1 runs before the shuffle, so a hot key
  is reduced to one row per map task before it is exchanged.
* ``asof_join`` unions both sides and runs one window; with ``bucket`` it splits
  each key into time buckets, so a key that holds a third of all rows is spread
  over many tasks, and carries the last right row between buckets through a
  small per-(key, bucket) table.
* ``interval_join`` with ``bucket`` equi-joins on (key, time bucket) so a hot
  key does not degenerate into one quadratic task.
* ``lookback_counts`` replaces a theta join (planned as a nested-loop join) by
  an explode into at most 31 candidate days and an equi aggregation; counts and
  sums have a cheaper form (``operators.sweep``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

ColLike = str | Column
AUTO_BUCKET = "30 days"


def _c(x: ColLike) -> Column:
    return F.col(x) if isinstance(x, str) else x


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column],
                   tiebreak: Sequence[Column] = (), rank_col: str | None = None) -> DataFrame:
    """Keep the first row per ``keys`` under ``order_by`` (+ ``tiebreak``).

    Replaces ``QUALIFY ROW_NUMBER() OVER (PARTITION BY keys ORDER BY ...) = 1``.
    Use ``F.desc_nulls_last(c)`` for latest-wins and ``F.asc(c)`` (nulls first,
    the SQL default) for earliest-wins.  ``rank_col`` keeps the row number.
    """
    w = Window.partitionBy(*keys).orderBy(*order_by, *tiebreak)
    rn = rank_col or "__rn"
    out = df.withColumn(rn, F.row_number().over(w)).filter(F.col(rn) == 1)
    return out if rank_col else out.drop(rn)


def earliest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[ColLike],
                     tiebreak: Sequence[Column] = ()) -> DataFrame:
    """Earliest row per key (ascending, NULLs first as in SQL)."""
    return latest_per_key(df, keys, [F.asc(_c(c)) for c in order_by], tiebreak)


def any_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key, chosen deterministically (smallest by all other columns).

    Replaces an unordered ``ROW_NUMBER() OVER (PARTITION BY keys) = 1``, which
    Spark rejects; ordering by every remaining column makes the pick stable
    between runs and engines.
    """
    rest = [F.asc(c) for c in df.columns if c not in keys]
    if not rest:  # the key is the whole row: any duplicate is identical
        return df.dropDuplicates(list(keys))
    return latest_per_key(df, keys, rest)


def smallest_measure_per_key(df: DataFrame, keys: Sequence[str], measure: str,
                             tiebreak: Sequence[Column] = ()) -> DataFrame:
    """Dedup where the smallest ``measure`` wins (E5)."""
    return latest_per_key(df, keys, [F.asc(measure)], tiebreak)


# ---------------------------------------------------------------------------
# as-of join (C9j) and validity-at variant (C21j)
# ---------------------------------------------------------------------------

def asof_join(left: DataFrame, right: DataFrame, by: Sequence[str], left_ts: str,
              right_ts: str, cols: Sequence[str], bucket: str | float | None = "auto",
              prefix: str = "") -> DataFrame:
    """Attach to each left row the latest right row with ``right_ts <= left_ts``.

    Left rows are all kept (a left as-of join); unmatched rows get NULLs.  The
    right side must have at most one row per (by, right_ts) - dedup first.

    Implementation: union both sides tagged 0 (right) / 1 (left), one window
    per key ordered by (ts, side) so an equal timestamp matches, and
    ``last(struct, ignorenulls)`` over the rows before.  No range join, no
    row blow-up.

    ``bucket`` additionally partitions by a bucket of the ordering value - a
    time span such as ``"30 days"`` for timestamps and dates, or a number
    (bucket width) for a numeric ordering value; the value carried into each
    bucket is the last right row of the earlier buckets of the key, taken
    from a small (key, bucket) table.  Keys with few distinct values (or one
    hot key) are thereby spread over many tasks.  By default times are split into
    ``AUTO_BUCKET``; None keeps a key together.
    """
    by = list(by)
    if bucket == "auto":
        timed = isinstance(left.schema[left_ts].dataType, (T.DateType, T.TimestampType, T.TimestampNTZType))
        bucket = AUTO_BUCKET if timed else None
    payload = F.struct(*[F.col(c).alias(c) for c in cols])
    # a right row without a timestamp can never be "at or before" anything
    r = right.filter(F.col(right_ts).isNotNull()).select(
        *by, F.col(right_ts).alias("__ts"), F.lit(0).alias("__side"), payload.alias("__r"))
    lcols = left.columns
    l = left.select(*by, F.col(left_ts).alias("__ts"), F.lit(1).alias("__side"),
                    F.lit(None).cast(r.schema["__r"].dataType).alias("__r"),
                    F.struct(*[F.col(c) for c in lcols]).alias("__l"))
    r = r.withColumn("__l", F.lit(None).cast(l.schema["__l"].dataType))
    u = r.unionByName(l)
    if bucket is None:
        w = (Window.partitionBy(*by).orderBy("__ts", "__side")
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
        m = u.withColumn("__m", F.last("__r", ignorenulls=True).over(w))
    else:
        if isinstance(bucket, str):
            tsc = F.col("__ts")
            if isinstance(u.schema["__ts"].dataType, T.DateType):
                tsc = tsc.cast("timestamp_ntz")
            bkt = F.window(tsc, bucket).start
        else:
            bkt = F.floor(F.col("__ts") / F.lit(float(bucket)))
        u = u.withColumn("__b", bkt)
        w = (Window.partitionBy(*by, "__b").orderBy("__ts", "__side")
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
        m = u.withColumn("__m", F.last("__r", ignorenulls=True).over(w))
        # last right row per (key, bucket); partial aggregation shrinks it map-side
        lastr = (u.filter("__side = 0")
                 .groupBy(*by, "__b")
                 .agg(F.max_by("__r", "__ts").alias("__lr")))
        # every bucket holding a left row gets the last right row of the
        # buckets before it: a small (key, bucket) table, one row per bucket
        lb = u.filter("__side = 1").select(*by, "__b").distinct()
        wb = (Window.partitionBy(*by).orderBy("__b")
              .rowsBetween(Window.unboundedPreceding, -1))
        carry = (lb.join(lastr, [*by, "__b"], "full")
                 .withColumn("__carry", F.last("__lr", ignorenulls=True).over(wb))
                 .select(*by, "__b", "__carry"))
        m = (m.filter("__side = 1").join(carry, [*by, "__b"], "left")
             .withColumn("__m", F.coalesce("__m", "__carry")))
    # equality on the keys: a NULL key never matches (SQL join semantics)
    keys_ok = F.lit(True)
    for k in by:
        keys_ok = keys_ok & F.col(k).isNotNull()
    m = m.withColumn("__m", F.when(keys_ok, F.col("__m")))
    out = m.filter("__side = 1")
    sel = [F.col("__l")[c].alias(c) for c in lcols]
    sel += [F.col("__m")[c].alias(prefix + c) for c in cols]
    return out.select(*sel)


def valid_at(left: DataFrame, changes: DataFrame, by: Sequence[str], left_ts: str,
             change_ts: str, cols: Sequence[str], prefix: str = "", bucket: str | float | None = "auto") -> DataFrame:
    """Value of a change-logged attribute valid at ``left_ts`` (C21j variant)."""
    return asof_join(left, changes, by, left_ts, change_ts, cols, bucket=bucket, prefix=prefix)


# ---------------------------------------------------------------------------
# interval joins (C10j, C11j, C13j, C14j)
# ---------------------------------------------------------------------------

def interval_join(left: DataFrame, right: DataFrame, by: Sequence[str], ts: ColLike,
                  start: ColLike, end: ColLike, closed: str = "left", how: str = "inner",
                  bucket_days: int | None = None, disjoint: bool = False, within: tuple[DataFrame, ColLike] | None = None) -> DataFrame:
    """Join rows of ``left`` whose ``ts`` lies in a ``right`` interval of the same key.

    ``closed="left"`` is the half-open ``[start, end)`` (status intervals),
    ``closed="both"`` is SQL ``BETWEEN`` (validity intervals).  Column
    expressions are resolved against ``left`` (``ts``) and ``right`` (``start``,
    ``end``).

    Without ``bucket_days`` this is an equi join on ``by`` with a range
    residual (sort-merge join + filter), right when each key has few intervals.
    With ``bucket_days`` each interval is exploded into the day buckets it
    covers (clipped to the buckets the left side occupies, found by one
    min / max aggregate) and the join also matches on the event's bucket:
    every (event, interval) pair is produced exactly once and a hot key is
    split over many tasks.  Outer joins that must keep unmatched *intervals*
    need the plain form (an interval spans several buckets).

    ``disjoint`` says that the intervals of a key don't overlap (empty ones are left out).
    With ``bucket_days``, an inner join is then one window over the rows of both sides, linear also in a
    hot key, so that buckets can be wide and intervals are in few of them.  ``within`` is a
    table and column that hold all times of ``left``, if that is cheaper to read.
    """
    ts_c, st_c, en_c = _c(ts), _c(start), _c(end)
    if closed == "left":
        cond = (ts_c >= st_c) & (ts_c < en_c)
    elif closed == "both":
        cond = (ts_c >= st_c) & (ts_c <= en_c)
    else:
        raise ValueError("closed must be 'left' or 'both'")
    # right keys are renamed so that self-joins (both sides from one scan)
    # cannot resolve to the same attribute
    if disjoint and (how != "inner" or bucket_days is None):
        raise ValueError("disjoint is for inner joins in buckets")
    rk = {k: f"__rk_{k}" for k in by}
    r = right.withColumnsRenamed(rk)
    keys = [F.col(k) == F.col(rk[k]) for k in by]
    if bucket_days is None:
        return left.join(r, [*keys, cond], how).drop(*rk.values())
    day = lambda c: F.floor(F.unix_date(F.to_date(c)) / bucket_days).cast("int")
    # clip each interval's bucket range to the buckets the left side occupies:
    # exact (no left row lies outside), and open-ended intervals ('valid until
    # 2099') no longer explode into thousands of empty buckets
    times, at = within or (left, ts)
    lo, hi = times.agg(F.min(day(_c(at))), F.max(day(_c(at)))).first()
    if lo is None:
        lo = hi = 0
    b0 = F.greatest(day(st_c), F.lit(lo))
    b1 = F.least(day(en_c), F.lit(hi))
    if disjoint:
        return _latest_start(left, right.withColumn("__b", F.explode(F.when(b0 <= b1, F.sequence(b0, b1)))), by, ts_c, st_c, en_c, closed, day(ts_c))
    r = r.withColumn("__rbk", F.explode(F.when(b0 <= b1, F.sequence(b0, b1))))
    l = left.withColumn("__lbk", day(ts_c))
    out = l.join(r, [*keys, F.col("__lbk") == F.col("__rbk"), cond], how)
    return out.drop(*rk.values(), "__lbk", "__rbk")


def _latest_start(left: DataFrame, right: DataFrame, by: Sequence[str], ts: Column, start: Column, end: Column, closed: str, bucket: Column) -> DataFrame:
    """Inner join of disjoint intervals, in each of their buckets ``__b``: only the latest
    one that has begun can hold a row."""
    by, cols, own = list(by), left.columns, [c for c in right.columns if c not in by and c != "__b"]
    known = lambda d: d.dropna(subset=by)
    r = known(right).filter(start <= end if closed == "both" else start < end)
    r = r.select(*by, "__b", start.alias("__at"), F.lit(0).alias("__side"), F.struct(*own, end.alias("__end")).alias("__r"))
    l = known(left).filter(ts.isNotNull()).select(*cols, bucket.alias("__b"), ts.alias("__at"), F.lit(1).alias("__side"))
    w = Window.partitionBy(*by, "__b").orderBy("__at", "__side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    m = l.unionByName(r, allowMissingColumns=True).withColumn("__m", F.last("__r", ignorenulls=True).over(w)).filter("__side = 1")
    end_c = F.col("__m.__end")
    return m.filter(F.col("__at") <= end_c if closed == "both" else F.col("__at") < end_c).select(*cols, *[F.col("__m")[c].alias(c) for c in own])


# ---------------------------------------------------------------------------
# last event before each row (C12j), open-ended intervals
# ---------------------------------------------------------------------------

def last_event_time(df: DataFrame, by: Sequence[str], ts: str, flag: ColLike,
                    name: str) -> DataFrame:
    """Timestamp of the latest flagged row at or before each row of the key.

    Equivalent to joining each row to the interval ``[event, next event)`` it
    falls in: those intervals tile the time axis, so a running max over the
    key replaces the range join.
    """
    w = (Window.partitionBy(*by).orderBy(ts)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return df.withColumn(name, F.max(F.when(_c(flag), F.col(ts))).over(w))


def close_intervals(df: DataFrame, by: Sequence[str], ts: str, end_name: str,
                    open_end: ColLike | None = None, block: Column | None = None) -> DataFrame:
    """Add ``end_name`` = next ``ts`` of the key, or ``open_end`` for the last row.

    Rows are split by key and ``block`` of time (30 days by default; it must never fall as
    ``ts`` rises).  The last row of a block takes the first ``ts`` of the key's next
    block, from the table with one row per key and block."""
    by = list(by)
    block = F.floor(F.unix_timestamp(ts) / F.lit(30 * 86_400)) if block is None else block
    rows = df.withColumns({"__b": block, "__last": F.lit(0)})
    per_block = Window.partitionBy(*by).orderBy("__b")
    firsts = rows.groupBy(*by, "__b").agg(F.min(ts).alias("__first"))
    ends = firsts.select(*by, "__b", F.lead("__first").over(per_block).alias("__then"), F.lit(1).alias("__last"))
    w = Window.partitionBy(*by, "__b").orderBy("__last", ts)
    nxt = F.lead(F.coalesce(F.col(ts), F.col("__then"))).over(w)
    out = rows.unionByName(ends, allowMissingColumns=True)
    out = out.withColumn(end_name, nxt if open_end is None else F.coalesce(nxt, _c(open_end)))
    return out.filter("__last = 0").drop("__b", "__last", "__then")


# ---------------------------------------------------------------------------
# calendar and month look-backs (C13j, C15j, C16j)
# ---------------------------------------------------------------------------

def rolling_month_sum(df: DataFrame, by: Sequence[str], date: str, value: str,
                      name: str) -> DataFrame:
    """Sum of ``value`` over ``[date - 1 month, date]`` per key (RANGE frame)."""
    frame = (f"sum({value}) OVER (PARTITION BY {', '.join(by)} ORDER BY {date} "
             f"RANGE BETWEEN INTERVAL 1 MONTH PRECEDING AND CURRENT ROW)")
    return df.withColumn(name, F.expr(frame))


def lookback_counts(spine: DataFrame, events: DataFrame, by: Sequence[str], spine_date: str,
                    event_date: str, measures: dict[str, Column], months: int = 1) -> DataFrame:
    """Aggregate events with ``add_months(d, -months) <= e <= d - 1`` per spine day.

    A theta-only condition would be planned as a nested-loop join.  Instead each
    event is exploded into its candidate spine days ``e+1 .. e+31*months``; the
    exact month bound is then applied and the result is an equi aggregation
    on (key, day), joined to the spine with a left join so empty days stay.
    ``measures`` maps output names to aggregate expressions over ``events``.
    """
    horizon = 31 * months
    cand = (events
            .withColumn("__d", F.explode(F.sequence(F.date_add(F.col(event_date), 1),
                                                     F.date_add(F.col(event_date), horizon))))
            .filter(F.add_months(F.col("__d"), -months) <= F.col(event_date)))
    agg = cand.groupBy(*by, "__d").agg(*[e.alias(n) for n, e in measures.items()])
    s = spine.alias("s")
    out = s.join(agg.alias("a"),
                 [F.col(f"s.{k}") == F.col(f"a.{k}") for k in by]
                 + [F.col(f"s.{spine_date}") == F.col("a.__d")], "left")
    return out.select("s.*", *[F.col(f"a.{n}") for n in measures])
