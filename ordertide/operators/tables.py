"""End-to-end table preparation with kept state.

``TablePreparer`` fills gaps (medians, modes), scales numbers and one-hot encodes
categories of any number of levels.  The fitted state is two tables - one row per
number column, one per level - that transform by joins and are written and read back as
Parquet with the model.  Levels get their places in the feature vector by counting per
hash bucket, so neither the levels nor their order pass through the driver, and the
vectors are sparse: a column has as many entries per row as it has levels set.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.ml.param.shared import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordertide.fixed import OTHER
from ordertide.operators.prep import rank_by_buckets
from ordertide.operators.quantiles import quantile_rows

_LEVELS = "column_name string, level string, n bigint, freq double, place bigint"
_NUMBERS = "column_name string, fill double, mean double, std double"


class _PreparerParams(Params):
    numericCols = Param(Params._dummy(), "numericCols", "number columns", TypeConverters.toListString)
    categoricalCols = Param(Params._dummy(), "categoricalCols", "category columns", TypeConverters.toListString)
    minCount = Param(Params._dummy(), "minCount", "levels rarer than this become OTHER", TypeConverters.toInt)
    frequencies = Param(Params._dummy(), "frequencies", "whether a level's frequency is a feature too", TypeConverters.toBoolean)
    outputCol = Param(Params._dummy(), "outputCol", "feature vector", TypeConverters.toString)

    def _of(self, name: str):
        return self.getOrDefault(name)


class TablePreparer(Estimator, _PreparerParams, DefaultParamsReadable, DefaultParamsWritable):
    """Learns fills, scales and levels from a training table.

    Null and NaN numbers take the column's median, null categories its most frequent
    level (the smallest of several); with ``minCount`` over 1, rarer levels are one level
    OTHER.  Numbers are scaled by mean and population deviation after the filling.  The
    smallest level of a column has no entry of its own; nor has a level never seen."""

    @keyword_only
    def __init__(self, *, numericCols=(), categoricalCols=(), minCount=1, frequencies=False, outputCol="features"):
        super().__init__()
        self._setDefault(numericCols=[], categoricalCols=[], minCount=1, frequencies=False, outputCol="features")
        self._set(numericCols=list(numericCols), categoricalCols=list(categoricalCols), minCount=minCount, frequencies=frequencies, outputCol=outputCol)

    def _fit(self, df: DataFrame) -> "TablePreparerModel":
        spark, numeric, categories = df.sparkSession, self._of("numericCols"), self._of("categoricalCols")
        fills = {c: q[0] for c, q in quantile_rows(df, numeric, [0.5]).items()}
        filled = [F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")), F.lit(fills[c])).alias(c) for c in numeric]
        stats = df.select(*filled).agg(*[e for i, c in enumerate(numeric) for e in (F.avg(c).alias(f"m{i}"), F.stddev_pop(c).alias(f"s{i}"))]).first() if numeric else None
        numbers = spark.createDataFrame([(c, fills[c], stats[f"m{i}"], stats[f"s{i}"]) for i, c in enumerate(numeric)], _NUMBERS)
        if not categories:
            return self._model(numbers, spark.createDataFrame([], _LEVELS))
        melted = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("level")) for c in categories])).alias("x"))
        counts = melted.select("x.*").groupBy("column_name", "level").agg(F.count(F.lit(1)).alias("n"))
        # nulls join the most frequent level, rare levels are one
        top = counts.filter("level IS NOT NULL").groupBy("column_name").agg(F.min(F.struct((-F.col("n")).alias("o"), "level"))["level"].alias("mode"))
        counts = counts.join(top, "column_name").withColumn("level", F.coalesce("level", "mode")).groupBy("column_name", "level").agg(F.sum("n").alias("n"))
        rare = F.when(F.col("n") >= self._of("minCount"), F.col("level")).otherwise(F.lit(OTHER))
        counts = counts.groupBy("column_name", rare.alias("level")).agg(F.sum("n").alias("n"))
        first = counts.groupBy("column_name").agg(F.min("level").alias("first"), F.sum("n").alias("all"))
        counts = counts.join(first, "column_name").withColumns({"freq": F.col("n") / F.col("all"), "__h": F.xxhash64("level")})
        placed = rank_by_buckets(counts.filter("level <> first"), F.shiftright("__h", 52), ["__h", "level"], ["column_name"], "place")
        levels = placed.select("column_name", "level", "n", "freq", (F.col("place") - 1).cast("bigint").alias("place")).unionByName(
            counts.filter("level = first").select("column_name", "level", "n", "freq", F.lit(None).cast("bigint").alias("place")))
        # the most frequent level fills nulls at transform time too
        return self._model(numbers, levels)

    def _model(self, numbers: DataFrame, levels: DataFrame) -> "TablePreparerModel":
        return self._copyValues(TablePreparerModel(numbers, levels))


class TablePreparerModel(Model, _PreparerParams, MLReadable, MLWritable):
    """The fitted state: ``numbers`` (column_name, fill, mean, std) and ``levels``
    (column_name, level, n, freq, place); a level without a place has no entry."""

    def __init__(self, numbers: DataFrame | None = None, levels: DataFrame | None = None):
        super().__init__()
        self._setDefault(numericCols=[], categoricalCols=[], minCount=1, frequencies=False, outputCol="features")
        self.numbers, self.levels = numbers, levels

    def widths(self) -> dict[str, int]:
        """Entries of each category column in the vector."""
        got = {r["column_name"]: r["w"] for r in self.levels.groupBy("column_name").agg((F.max("place") + 1).alias("w")).collect()}
        return {c: int(got.get(c) or 0) for c in self._of("categoricalCols")}

    def offsets(self) -> dict[str, int]:
        """Where each category column's entries begin; numbers (and frequencies) stand before."""
        at, out = len(self._of("numericCols")) + (len(self._of("categoricalCols")) if self._of("frequencies") else 0), {}
        for c, w in self.widths().items():
            out[c], at = at, at + w
        return out

    def _transform(self, df: DataFrame) -> DataFrame:
        numeric, categories, keep = self._of("numericCols"), self._of("categoricalCols"), df.columns
        own = {r["column_name"]: r for r in self.numbers.collect()}              # one row per number column
        out = df
        for i, c in enumerate(numeric):
            r = own[c]
            x = F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")), F.lit(r["fill"]))
            out = out.withColumn(f"__n{i}", F.coalesce((x - F.lit(r["mean"])) / F.lit(r["std"] or 1.0), F.lit(0.0)))
        widths, parts = self.widths(), [f"__n{i}" for i in range(len(numeric))]
        modes = {r["column_name"]: r["level"] for r in self.levels.groupBy("column_name").agg(
            F.min(F.struct((-F.col("n")).alias("o"), "level"))["level"].alias("level")).collect()}
        for i, c in enumerate(categories):
            mine = self.levels.filter(F.col("column_name") == c).select(F.col("level").alias(f"__l{i}"), F.col("place").alias(f"__p{i}"), F.col("freq").alias(f"__f{i}"))
            # a level that training saw stays; another one is OTHER, if training had it
            out = out.withColumn(f"__v{i}", F.coalesce(F.col(c).cast("string"), F.lit(modes.get(c))))
            out = out.join(mine, F.col(f"__v{i}") == F.col(f"__l{i}"), "left")
            other = self.levels.filter((F.col("column_name") == c) & (F.col("level") == OTHER)).first()
            out = out.withColumns({f"__p{i}": F.when(F.col(f"__l{i}").isNull(), F.lit(other["place"] if other else None)).otherwise(F.col(f"__p{i}")),
                                   f"__f{i}": F.when(F.col(f"__l{i}").isNull(), F.lit(other["freq"] if other else 0.0)).otherwise(F.col(f"__f{i}"))})
            out = out.withColumn(f"__p{i}", F.coalesce(f"__p{i}", F.lit(widths[c])).cast("double"))
        if self._of("frequencies"):
            parts += [f"__f{i}" for i in range(len(categories))]
        hot = [i for i, c in enumerate(categories) if widths[c]]
        if hot:
            # the place after the last is that of rows without an entry; it is dropped
            sizes = df.sparkSession.createDataFrame([[float(widths[categories[i]] - 1) for i in hot]], [f"__p{i}" for i in hot])
            coder = OneHotEncoder(inputCols=[f"__p{i}" for i in hot], outputCols=[f"__h{i}" for i in hot], dropLast=True, handleInvalid="keep").fit(sizes)
            out = coder.transform(out)
            parts += [f"__h{i}" for i in hot]
        out = VectorAssembler(inputCols=parts, outputCol=self._of("outputCol"), handleInvalid="keep").transform(out)
        return out.select(*keep, self._of("outputCol"))

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader(cls)


class _Writer(MLWriter):
    def __init__(self, model: TablePreparerModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession)
        self.model.numbers.write.parquet(f"{path}/numbers")
        self.model.levels.write.parquet(f"{path}/levels")


class _Reader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> TablePreparerModel:
        spark: SparkSession = self.sparkSession
        meta = DefaultParamsReader.loadMetadata(path, spark)
        model = self.cls(spark.read.schema(_NUMBERS).parquet(f"{path}/numbers"), spark.read.schema(_LEVELS).parquet(f"{path}/levels"))
        model._resetUid(meta["uid"])
        DefaultParamsReader.getAndSetParams(model, meta)
        return model


def named_entries(model: TablePreparerModel, df: DataFrame, key: Sequence[str]) -> DataFrame:
    """(key..., column_name, level): the levels whose entries are set in a row's vector."""
    from pyspark.ml.functions import vector_to_array
    vector = vector_to_array(model.getOrDefault("outputCol"))
    rows = df.select(*key, F.posexplode(vector).alias("at", "v")).filter("v <> 0")
    offsets = model.offsets()
    at = F.create_map(*[F.lit(x) for kv in offsets.items() for x in kv])
    names = model.levels.filter("place IS NOT NULL").select("column_name", "level", (F.col("place") + at[F.col("column_name")]).alias("at"))
    return rows.join(names, "at").select(*key, "column_name", "level")
