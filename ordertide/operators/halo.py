"""Window frames over keyed time series, split by (key, time block).

A plain ``Window.partitionBy(key)`` puts all rows of a key into one task.  Here a task
gets one *block* of a key, together with

* its own rows,
* a halo: the rows of the one other block in which a frame of the block can begin, and
* a carry row: a summary of all blocks between (and before) them, computed on the
  small table with one row per key and block.

Sums over a trailing RANGE frame become one running sum inside the block: own rows
count from their time on, halo rows are taken off again once the frame has left them,
and the carry row holds what the frame covers at the start of the block.  So each row
is copied once, however many blocks a frame spans, and a key with a third of all
rows is spread over as many tasks as it has blocks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordertide.functions.scalars import epoch_seconds

ColLike = str | Column
DAY_SECONDS = 86_400


def _c(x: ColLike) -> Column:
    return F.col(x) if isinstance(x, str) else x


def stacked(*parts: DataFrame) -> DataFrame:
    """Rows of all parts; columns that a part lacks are null."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def moving_sums(rows: DataFrame, by: Sequence[str], block: str, offset: str, sums: Sequence[str], span: int,
                latest: Sequence[str] = (), keep: Sequence[str] = (), time: str | None = None) -> DataFrame:
    """``rows`` plus, per column ``c`` of ``sums``, ``sum_c``: its sum over the rows of the
    key from the same offset ``span`` blocks before up to the row (peers included).

    ``block`` and ``offset`` say where a row stands: the number of its block and its
    whole-number place in it.  ``latest`` columns give ``latest_c``, the highest value of
    the key up to the row (with ``time``, rows of an equal offset are told apart by that
    column).  ``keep`` are the columns of ``rows`` that come along; nulls in ``block`` form
    a block of their own, as null order values are peers of each other."""
    by = list(by)
    own = rows.select(*by, block, offset, *[c for c in dict.fromkeys([*sums, *latest, *keep, *([time] if time else [])])
                                            if c not in (*by, block, offset)], F.lit(True).alias("__own"))
    halo = (rows.filter(F.col(block).isNotNull())
            .select(*by, (F.col(block) + span).alias(block), (F.col(offset) + 1).alias(offset), *[(-F.col(c)).alias(c) for c in sums]))
    blocks = rows.groupBy(*by, block).agg(*[F.sum(c).alias(c) for c in sums], *[F.max(c).alias(c) for c in latest])
    key = Window.partitionBy(*by).orderBy(block)
    before, ever = key.rangeBetween(-span, -1), key.rangeBetween(Window.unboundedPreceding, -1)
    carry = (blocks.select(*by, block, F.lit(-1).alias(offset), *[F.sum(c).over(before).alias(c) for c in sums],
                           *[F.max(c).over(ever).alias(c) for c in latest]).filter(F.col(block).isNotNull()))
    run = Window.partitionBy(*by, block).orderBy(offset).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    order = Window.partitionBy(*by, block).orderBy(offset, *([time] if time else [])).rangeBetween(
        Window.unboundedPreceding, Window.currentRow)
    out = stacked(own, halo, carry)
    # the finer order first: its sort serves both windows
    out = out.withColumns({f"latest_{c}": F.max(c).over(order) for c in latest}) if latest else out
    out = out.withColumns({f"sum_{c}": F.sum(c).over(run) for c in sums})
    return out.filter("__own").drop("__own")


_NEEDS = {"sum": "s", "count": "n", "avg": "ns", "var_samp": "nsq", "stddev_samp": "nsq", "var_pop": "nsq", "stddev_pop": "nsq"}


def trailing_stats(df: DataFrame, by: Sequence[str], ts: str, aggs: dict[str, tuple[str, ColLike]], days: int = 28,
                   unit: str = "seconds", blocks: int | None = None, pivot: float = 0.0) -> DataFrame:
    """Aggregates over the trailing ``days`` window ending at the current row, split by
    key and block (``windows.trailing_stats`` is the form with a key per task).

    ``unit`` as there: whole epoch seconds, or days of a DATE.  The window is cut into
    ``blocks`` blocks (one a day by default; more for a key whose days are still too
    large).  Sums, counts, averages, variances and deviations are offered; variances
    come from sums of squares of the distance to ``pivot``, which should lie near the
    values if they are large against their spread."""
    order, frame = (epoch_seconds(F.col(ts)), days * DAY_SECONDS) if unit == "seconds" else (F.unix_date(F.col(ts)), days)
    blocks = blocks or days
    width, rest = divmod(frame, blocks)
    if rest:
        raise ValueError("blocks must divide the frame")
    unknown = {a for a, _ in aggs.values()} - set(_NEEDS)
    if unknown:
        raise ValueError(f"not sums over a frame: {sorted(unknown)}")
    place, cols, need = {}, {}, {}
    for a, c in aggs.values():
        i = place.setdefault(str(c), len(place))
        for part in _NEEDS[a]:
            col, gap = _c(c), _c(c) - F.lit(pivot)
            need[f"__{part}{i}"] = {"n": F.when(col.isNotNull(), F.lit(1).cast("long")), "s": col, "q": gap * gap}[part]
            cols[f"__{part}{i}"] = None
    rows = df.select(F.struct(*df.columns).alias("__row"), *by, F.floor(order / F.lit(width)).cast("long").alias("__b"),
                     F.pmod(order, F.lit(width)).cast("long").alias("__o"), *[e.alias(n) for n, e in need.items()])
    out = moving_sums(rows, by, "__b", "__o", list(cols), blocks, keep=["__row"])

    def result(agg: str, i: int) -> Column:
        n, s, q = (F.col(f"sum___{p}{i}") for p in "nsq")
        if agg == "count":
            return F.coalesce(n, F.lit(0).cast("long"))
        # a frame with no value left has no sum; what rounding leaves of it doesn't count
        if agg == "sum":
            return s
        if agg == "avg":
            return F.when(n > 0, s / n)
        gap = s - n * F.lit(pivot)
        spread = F.greatest(q - gap * gap / n, F.lit(0.0))
        var = F.when(n > 1, spread / (n - 1)) if agg.endswith("samp") else F.when(n > 0, spread / n)
        return F.sqrt(var) if agg.startswith("stddev") else var

    return out.select("__row.*", *[result(a, place[str(c)]).alias(name) for name, (a, c) in aggs.items()])


def prior_rows_stats(df: DataFrame, by: Sequence[str], order: str, value: str, block: Column, n: int = 30,
                     size: int = 512, prefix: str = "") -> DataFrame:
    """Mean, sample deviation and count over the ``n`` rows before each row (ROWS frame).

    Rows are numbered per key through counts per ``block`` (a value that never falls as
    ``order`` rises), then cut into blocks of ``size`` rows, each with the last ``n`` rows
    of the one before as its halo.  ``order`` must not repeat within a key."""
    if size < n:
        raise ValueError("a block must hold at least the frame")
    by = list(by)
    rows = df.withColumn("__t", block)
    key = Window.partitionBy(*by).orderBy("__t")
    counts = rows.groupBy(*by, "__t").agg(F.count(F.lit(1)).alias("__n"))
    counts = counts.select(*by, "__t", F.coalesce(F.sum("__n").over(key.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"))
    place = Window.partitionBy(*by, "__t").orderBy("__own", order)
    # the carry row is the first of its block: own rows count from 2 on
    at = F.row_number().over(place) - 2 + F.first("__before").over(place)
    rows = stacked(rows.withColumn("__own", F.lit(True)), counts.withColumn("__own", F.lit(False))).withColumn("__at", at).filter("__own")
    rows = rows.drop("__before", "__t").withColumn("__b", F.floor(F.col("__at") / size))
    halo = rows.filter(F.pmod("__at", F.lit(size)) >= size - n).select(*by, "__at", value, (F.col("__b") + 1).alias("__b"))
    w = Window.partitionBy(*by, "__b").orderBy("__at").rowsBetween(-n, -1)
    return stacked(rows, halo).withColumns({
        f"{prefix}avg": F.avg(value).over(w), f"{prefix}stddev": F.stddev_samp(value).over(w),
        f"{prefix}n": F.count(F.lit(1)).over(w)}).filter("__own").drop("__own", "__at", "__b")


def previous_and_latest(df: DataFrame, by: Sequence[str], block: Column, order: Sequence[str], previous: dict[str, str],
                        carried: DataFrame | None = None) -> DataFrame:
    """``df`` plus, per name of ``previous``, the value that its column has in the key's row
    before (LAG by ``order``), over all blocks.

    ``carried`` may name a table of (by, ``__b``, ...) whose other columns, one row per key
    and block, are attached to every row of the block; the table must have a row for
    each block of ``df``."""
    by = list(by)
    rows = df.withColumn("__b", block)
    last = rows.groupBy(*by, "__b").agg(*[F.max_by(c, F.struct(*order)).alias(f"__l{i}") for i, c in enumerate(previous.values())])
    key = Window.partitionBy(*by).orderBy("__b")
    carry = last.select(*by, "__b", *[F.lag(f"__l{i}").over(key).alias(f"__l{i}") for i in range(len(previous))])
    extra = [] if carried is None else [c for c in carried.columns if c not in (*by, "__b")]
    both = stacked(rows.withColumn("__own", F.lit(2)), carry.withColumn("__own", F.lit(1)),
                   *([] if carried is None else [carried.withColumn("__own", F.lit(0))]))
    w = Window.partitionBy(*by, "__b").orderBy("__own", *order)
    out = both.withColumn("__lo", F.lag("__own").over(w)).withColumns({
        name: F.when(F.col("__lo") == 2, F.lag(c).over(w)).otherwise(F.last(f"__l{i}", ignorenulls=True).over(w))
        for i, (name, c) in enumerate(previous.items())})
    if extra:
        top = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        out = out.withColumns({c: F.first(c).over(top) for c in extra})
    return out.filter("__own = 2").drop("__own", "__lo", *[f"__l{i}" for i in range(len(previous))])


def latest_flagged(df: DataFrame, by: Sequence[str], ts: str, flags: dict[str, Column], block: Column | None = None) -> DataFrame:
    """``df`` plus, per name of ``flags``, the latest ``ts`` of the key's flagged rows at or
    before the row (peers included); ``block`` defaults to the day."""
    by = list(by)
    block = F.floor(epoch_seconds(F.col(ts)) / F.lit(DAY_SECONDS)) if block is None else block
    rows = df.withColumn("__b", block).withColumns({f"__f{i}": F.when(f, F.col(ts)) for i, f in enumerate(flags.values())})
    marks = [f"__f{i}" for i in range(len(flags))]
    key = Window.partitionBy(*by).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    carry = rows.groupBy(*by, "__b").agg(*[F.max(m).alias(m) for m in marks])
    carry = carry.select(*by, "__b", *[F.max(m).over(key).alias(m) for m in marks], F.lit(0).alias("__own"))
    w = Window.partitionBy(*by, "__b").orderBy("__own", ts).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    out = stacked(rows.withColumn("__own", F.lit(1)), carry).withColumns({n: F.max(m).over(w) for n, m in zip(flags, marks)})
    return out.filter("__own = 1").drop("__own", "__b", *marks)
