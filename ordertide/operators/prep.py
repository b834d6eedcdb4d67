"""

Fitting computes small statistics in one aggregation pass (medians, modes,
means, level lists, category counts); applying them is a projection or a
join against a table with one row per level.  Level lists are bounded by the
cardinality of a categorical column and are checked against ``max_levels``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Estimator, Model
from pyspark.ml.param.shared import Param, Params, TypeConverters
from pyspark.ml.util import (DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader,
                             MLWritable, MLWriter)
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordertide.fixed import OTHER, TIERS
from ordertide.functions.scalars import level_indicator
from ordertide.operators.quantiles import exact_quantiles, quantile_rows

MAX_LEVELS = 10_000


# ---------------------------------------------------------------------------
# imputation
# ---------------------------------------------------------------------------

def fit_medians(df: DataFrame, cols: Sequence[str]) -> dict[str, float]:
    """Interpolated median of each column (None without values)."""
    return {c: q[0] for c, q in quantile_rows(df, cols, [0.5]).items()}


def fit_modes(df: DataFrame, cols: Sequence[str]) -> dict[str, object]:
    """Most frequent value, smallest on ties (distributed count + top-1)."""
    out = {}
    for c in cols:
        top = (df.filter(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("n"))
               .orderBy(F.desc("n"), F.asc(c)).limit(1).first())
        out[c] = None if top is None else top[c]
    return out


def fit_max_plus_one(df: DataFrame, cols: Sequence[str]) -> dict[str, float]:
    """``max + 1`` ("never happened") fill value."""
    r = df.agg(*[F.max(c).alias(c) for c in cols]).first()
    return {c: (None if r[c] is None else r[c] + 1) for c in cols}


def fill(df: DataFrame, values: dict[str, object]) -> DataFrame:
    """Apply fitted fill values (I1-I4); NaN counts as missing for doubles."""
    def miss(c):
        t = df.schema[c].dataType.simpleString()
        m = F.col(c).isNull()
        return m | F.isnan(F.col(c)) if t in ("double", "float") else m
    return df.withColumns({c: F.when(miss(c), F.lit(v)).otherwise(F.col(c))
                           for c, v in values.items() if v is not None})


def group_median_fill(df: DataFrame, col: str, by: Sequence[str]) -> DataFrame:
    """Fill NULLs with the interpolated median of the row's group; a group without
    values stays NULL.  Medians are one row per group, joined to the rows that need one."""
    by = list(by)
    med = exact_quantiles(df, [col], [0.5], by).select(*[F.col(k).alias(f"__{k}") for k in by], F.col("value").alias("__median"))
    on = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in by]
    gaps = df.filter(F.col(col).isNull()).join(med, on, "left").withColumn(col, F.col("__median")).select(*df.columns)
    return df.filter(F.col(col).isNotNull()).withColumn(col, F.col(col).cast("double")).unionByName(gaps)


# ---------------------------------------------------------------------------
# scaling and encoding
# ---------------------------------------------------------------------------

def fit_standardiser(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and *population* standard deviation per column, one pass."""
    r = df.agg(*[e for c in cols for e in (F.avg(c).alias(f"{c}__m"), F.stddev_pop(c).alias(f"{c}__s"))]).first()
    return {c: (r[f"{c}__m"], r[f"{c}__s"]) for c in cols}


def standardise(df: DataFrame, stats: dict[str, tuple[float, float]]) -> DataFrame:
    """(x - mean) / std_pop; a zero std leaves the centred value."""
    return df.withColumns({c: (F.col(c) - F.lit(m)) / F.lit(s if s else 1.0) for c, (m, s) in stats.items()})


def levels(df: DataFrame, col: str, max_levels: int = MAX_LEVELS) -> list:
    """Sorted distinct non-null levels of a categorical column (bounded)."""
    got = [r[0] for r in df.select(col).where(F.col(col).isNotNull()).distinct()
           .orderBy(col).limit(max_levels + 1).collect()]
    if len(got) > max_levels:
        raise ValueError(f"{col} has more than {max_levels} levels")
    return got


def level_name(prefix: str, level) -> str:
    return f"{prefix}_{level}".replace(" ", "_")


def one_hot(df: DataFrame, col: str, lvls: Sequence, drop_first: bool = True, prefix: str | None = None,
            keep: bool = False) -> DataFrame:
    """0/1 columns for frozen ``lvls`` (first level dropped when
    ``drop_first``); unseen levels give all zeros."""
    prefix = prefix or col
    use = list(lvls)[1:] if drop_first else list(lvls)
    out = df.withColumns({level_name(prefix, v): (F.col(col) == F.lit(v)).cast("int") for v in use})
    out = out.fillna(0, [level_name(prefix, v) for v in use])
    return out if keep else out.drop(col)


def level_indicators(df: DataFrame, col: str, lvls: Sequence, prefix: str) -> DataFrame:
    """I32: one NULL-safe indicator per level, ``None`` included as a level."""
    return df.withColumns({level_name(prefix, "null" if v is None else v):
                           level_indicator(col, v) for v in lvls})


def category_counts(df: DataFrame, col: str) -> DataFrame:
    """Count and frequency of each level (I10 fit); the total is a scalar."""
    total = df.count()
    c = df.groupBy(col).agg(F.count(F.lit(1)).alias(f"{col}_count"))
    return c.withColumn(f"{col}_freq", F.col(f"{col}_count") / F.lit(float(total)))


def count_freq_encode(df: DataFrame, col: str, fitted_counts: DataFrame) -> DataFrame:
    """Attach the fitted count / frequency; unseen levels get NULL."""
    return df.join(fitted_counts, col, "left")


def rare_group(df: DataFrame, col: str, min_count: int, other: str = OTHER,
               fitted_counts: DataFrame | None = None) -> DataFrame:
    """Levels seen fewer than ``min_count`` times (or unseen) -> ``other``.

    NULL stays NULL.  Counts come from ``fitted_counts`` (train) or ``df``.
    """
    counts = fitted_counts if fitted_counts is not None else category_counts(df, col)
    frequent = counts.filter(F.col(f"{col}_count") >= min_count).select(F.col(col).alias("__lvl"))
    j = df.join(frequent, df[col] == F.col("__lvl"), "left")
    return j.withColumn(col, F.when(F.col(col).isNull(), F.lit(None).cast("string"))
                        .when(F.col("__lvl").isNull(), F.lit(other)).otherwise(F.col(col))).drop("__lvl")


class _EncParams(Params):
    inputCol = Param(Params._dummy(), "inputCol", "categorical column", TypeConverters.toString)
    minCount = Param(Params._dummy(), "minCount", "levels rarer than this become OTHER", TypeConverters.toInt)
    dropFirst = Param(Params._dummy(), "dropFirst", "drop the first one-hot level", TypeConverters.toBoolean)


class HybridEncoder(Estimator, _EncParams, DefaultParamsReadable, DefaultParamsWritable):
    """Rare grouping + count / frequency encoding + frozen one-hot.

    ``fit`` learns the level counts on the training frame (one aggregation);
    the model keeps them as a small frame and the frozen level list.
    """

    def __init__(self, inputCol: str = "category", minCount: int = 100, dropFirst: bool = True):
        super().__init__()
        self._setDefault(inputCol="category", minCount=100, dropFirst=True)
        self._set(inputCol=inputCol, minCount=minCount, dropFirst=dropFirst)

    def _fit(self, df: DataFrame) -> "HybridEncoderModel":
        col, k = self.getOrDefault("inputCol"), self.getOrDefault("minCount")
        grouped = rare_group(df, col, k)
        counts = category_counts(grouped, col)
        lv = levels(grouped, col)
        rows = [(r[col], r[f"{col}_count"], r[f"{col}_freq"]) for r in counts.collect()]
        kept = sorted(r[0] for r in category_counts(df, col).filter(F.col(f"{col}_count") >= k)
                      .select(col).collect() if r[0] is not None)
        return HybridEncoderModel(col, self.getOrDefault("dropFirst"), kept, lv, rows)


class HybridEncoderModel(Model, _EncParams, MLReadable, MLWritable):
    """The fitted levels: ``frequent`` ones stay, ``lvls`` have a column each, ``counts`` are rows
    (level, count, frequency).  They are saved with the model, as Parquet."""

    def __init__(self, col: str = "category", drop_first: bool = True, frequent: Sequence = (), lvls: Sequence = (), counts: Sequence = ()):
        super().__init__()
        self._setDefault(inputCol="category", minCount=100, dropFirst=True)
        self._set(inputCol=col, dropFirst=drop_first)
        self.frequent, self.lvls, self.counts = list(frequent), list(lvls), list(counts)

    @property
    def col(self) -> str:
        return self.getOrDefault("inputCol")

    @property
    def drop_first(self) -> bool:
        return self.getOrDefault("dropFirst")

    def write(self) -> MLWriter:
        return _HybridWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _HybridReader(cls)

    def _transform(self, df: DataFrame) -> DataFrame:
        c = self.col
        spark = df.sparkSession
        g = df.withColumn(c, F.when(F.col(c).isNull(), F.lit(None).cast("string"))
                          .when(F.col(c).isin(self.frequent), F.col(c)).otherwise(F.lit(OTHER)))
        cnt = spark.createDataFrame(self.counts, f"{c} string, {c}_count bigint, {c}_freq double")
        # one row per fitted level: bounded by the level list checked at fit
        g = g.join(F.broadcast(cnt), c, "left")
        return one_hot(g, c, self.lvls, self.drop_first, keep=True)


_LEVEL_ROWS = "kind string, place int, level string, n bigint, freq double"


class _HybridWriter(MLWriter):
    def __init__(self, model: HybridEncoderModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        m = self.model
        DefaultParamsWriter.saveMetadata(m, path, self.sparkSession)
        rows = [("frequent", i, v, None, None) for i, v in enumerate(m.frequent)] + [("column", i, v, None, None) for i, v in enumerate(m.lvls)]
        rows += [("count", i, v, n, f) for i, (v, n, f) in enumerate(m.counts)]
        self.sparkSession.createDataFrame(rows, _LEVEL_ROWS).write.parquet(f"{path}/levels")


class _HybridReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> HybridEncoderModel:
        meta = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        rows = sorted(self.sparkSession.read.schema(_LEVEL_ROWS).parquet(f"{path}/levels").collect(), key=lambda r: r.place)   # fitted levels: bounded
        of = lambda kind: [r for r in rows if r.kind == kind]
        model = self.cls(frequent=[r.level for r in of("frequent")], lvls=[r.level for r in of("column")],
                         counts=[(r.level, r.n, r.freq) for r in of("count")])
        model._resetUid(meta["uid"])
        DefaultParamsReader.getAndSetParams(model, meta)
        return model


# ---------------------------------------------------------------------------
# tiers, top-N, rare flags, shares
# ---------------------------------------------------------------------------

def frequency_tiers(df: DataFrame, group: str, name: str = "tier") -> DataFrame:
    """LARGE / MEDIUM / SMALL by group size at its 75th / 25th percentile.

    The two thresholds are scalars, interpolated between the counts next to them.
    """
    counts = df.groupBy(group).agg(F.count(F.lit(1)).alias("n"))
    q25, q75 = quantile_rows(counts, ["n"], [0.25, 0.75])["n"]
    return counts.withColumn(name, F.when(F.col("n") >= q75, TIERS[0])
                             .when(F.col("n") >= q25, TIERS[1]).otherwise(TIERS[2])).select(group, "n", name)


def top_n_levels(df: DataFrame, col: str, n: int, weight: Column | None = None) -> list:
    """I14 fit: the ``n`` heaviest levels (ties by level), NULL excluded."""
    w = F.count(F.lit(1)) if weight is None else F.sum(weight)
    rows = (df.filter(F.col(col).isNotNull()).groupBy(col).agg(w.alias("__w"))
            .orderBy(F.desc("__w"), F.asc(col)).limit(n).collect())
    return [r[col] for r in rows]


def top_n_other(df: DataFrame, col: str, keep: Sequence, other: str = OTHER) -> DataFrame:
    """I14 apply: levels outside ``keep`` -> ``other``; NULL kept apart."""
    return df.withColumn(col, F.when(F.col(col).isNull(), F.lit(None).cast("string"))
                         .when(F.col(col).isin(list(keep)), F.col(col)).otherwise(F.lit(other)))


def rare_flag_plan(df: DataFrame, flags: Sequence[str], min_ones: int = 20) -> DataFrame:
    """Per 0/1 flag the number of ones and the action keep / merge / drop."""
    one = df.agg(*[F.sum(F.col(f).cast("bigint")).alias(f) for f in flags])
    parts = [F.struct(F.lit(f).alias("flag"), F.col(f).alias("n_ones")) for f in flags]
    t = one.select(F.explode(F.array(*parts)).alias("r")).select("r.*")
    return t.withColumn("action", F.when(F.col("n_ones") == 0, "drop")
                        .when(F.col("n_ones") < min_ones, "merge").otherwise("keep"))


def squared(df: DataFrame, cols: Sequence[str], suffix: str = "_sq") -> DataFrame:
    """Squared terms."""
    return df.withColumns({f"{c}{suffix}": F.pow(F.col(c), 2) for c in cols})


# ---------------------------------------------------------------------------
# splits and samples
# ---------------------------------------------------------------------------

def rank_by_buckets(df: DataFrame, bucket: Column, order: Sequence[str],
                    strata: Sequence[str] = (), name: str = "__rank") -> DataFrame:
    """Exact rank of each row by (``bucket``, ``order``) within ``strata``.

    ``bucket`` must be monotonic in the ordering (e.g. the minute of a
    timestamp, or the top bits of a hash).  Rows are counted per bucket (a
    small table), cumulative counts give each bucket's offset, and rows are
    ranked only inside their bucket, so no step sorts the whole frame in
    one task.
    """
    strata = list(strata)
    b = df.withColumn("__b", bucket)
    counts = b.groupBy(*strata, "__b").agg(F.count(F.lit(1)).alias("__n"))
    wc = Window.partitionBy(*strata).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("__before", F.coalesce(F.sum("__n").over(wc), F.lit(0)))
    j = b.join(counts, [*strata, "__b"])
    wr = Window.partitionBy(*strata, "__b").orderBy(*order)
    return j.withColumn(name, F.col("__before") + F.row_number().over(wr)).drop("__b", "__n", "__before")


def time_split(df: DataFrame, ts: str, key: Sequence[str], train_share: float = 0.8,
               name: str = "split") -> DataFrame:
    """The first ``int(share * n)`` rows by (ts, key) are 'train'; ``key`` must tell rows
    of one time apart.  Rows without a time are the first.

    Rows are counted per minute (one row per minute: the count of any span), and only
    the minute that holds the cut is put in order, down to the cut, to find the last
    training row.  The split itself is a comparison with that row: no row is moved,
    however many share a time.
    """
    minute = F.coalesce(F.floor(F.unix_timestamp(ts) / 60), F.lit(-(1 << 40)))
    per = df.groupBy(minute.alias("m")).agg(F.count(F.lit(1)).alias("n"))
    upto = per.select("m", "n", F.sum("n").over(Window.orderBy("m")).alias("upto"), F.sum("n").over(Window.partitionBy()).alias("all"))
    cut = F.floor(F.lit(float(train_share)) * F.col("all"))
    at = upto.filter((F.col("upto") >= cut) & (F.col("upto") - F.col("n") < cut)).select("m", (cut - (F.col("upto") - F.col("n"))).alias("r")).first()
    if at is None:                                  # no training rows at all
        return df.withColumn(name, F.lit("test"))
    order = [F.asc_nulls_first(ts), *[F.asc_nulls_first(k) for k in key]]
    place = lambda: F.struct(F.col(ts), *[F.col(k) for k in key])
    last = df.filter(minute == at["m"]).orderBy(*order).limit(int(at["r"])).agg(F.max(place()).alias("x"))
    return df.withColumn(name, F.when(place() <= last.scalar(), "train").otherwise("test"))


def key_hash(key: Sequence[str]) -> Column:
    """A whole number below 2^60 from the MD5 of the key's text, the same in every engine."""
    text = F.concat_ws("|", *[F.col(k).cast("string") for k in key])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("bigint")


def hash_sample(df: DataFrame, key: Sequence[str], buckets: int = 10, keep: int = 0) -> DataFrame:
    """Deterministic sample, rows whose key hashes into bucket ``keep``."""
    return df.filter(F.pmod(key_hash(key), F.lit(buckets)) == keep)


def ratio_sample(df: DataFrame, label: str, key: Sequence[str], ratio: float = 3.0,
                 strata: Sequence[str] = ()) -> DataFrame:
    """All positives plus ``ratio`` times as many negatives per stratum,
    negatives taken in hash order of the key (exact, no global sort)."""
    strata = list(strata)
    pos = df.filter(F.col(label) == 1)
    neg = df.filter(F.col(label) == 0).withColumn("__h", key_hash(key))
    neg = rank_by_buckets(neg, F.shiftright("__h", 44), ["__h", *key], strata, "__r")
    if strata:   # positives per stratum: one row per stratum
        neg = neg.join(pos.groupBy(*strata).agg(F.count(F.lit(1)).alias("__np")), strata, "left")
    else:        # one scalar
        neg = neg.withColumn("__np", F.lit(pos.count()))
    neg = neg.filter(F.col("__r") <= F.coalesce(F.col("__np"), F.lit(0)) * ratio)
    return pos.unionByName(neg.select(*df.columns))
