"""

Readers return lazy DataFrames (column pruning and filters reach the Parquet
scan).  Writers overwrite or append whole datasets; partitioned writes
spread a hot date over several tasks by hashing the clustering keys too.
Errors are raised, never swallowed (the warehouse extractor returned ``[]``
on any error).
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


# ---------------------------------------------------------------------------
# readers (A1-A3)
# ---------------------------------------------------------------------------

def read_table(spark: SparkSession, name_or_path: str, fmt: str = "parquet") -> DataFrame:
    """A1: whole table by catalog name, or a dataset by path."""
    if "/" in name_or_path or name_or_path.endswith(f".{fmt}"):
        return spark.read.format(fmt).load(name_or_path)
    return spark.table(name_or_path)


def read_csv(spark: SparkSession, path: str, schema: StructType | str, header: bool = True) -> DataFrame:
    """A2: CSV with a header and an explicit schema (no inference pass)."""
    return spark.read.csv(path, schema=schema, header=header, mode="FAILFAST")


def read_or_empty(spark: SparkSession, path: str, schema: StructType | str, fmt: str = "parquet") -> DataFrame:
    """A3: the dataset at ``path``, or an empty frame with ``schema`` when it is missing."""
    from py4j.protocol import Py4JJavaError
    try:
        if fmt == "csv":
            return read_csv(spark, path, schema)
        return spark.read.schema(schema).format(fmt).load(path)
    except Exception as ex:  # a missing path surfaces as an analysis error
        if "PATH_NOT_FOUND" in str(ex) or isinstance(ex, Py4JJavaError) and "FileNotFound" in str(ex):
            return spark.createDataFrame([], schema)
        raise


# ---------------------------------------------------------------------------
# writers (A4-A13)
# ---------------------------------------------------------------------------

def export_query(spark: SparkSession, query: str | DataFrame, path: str, fmt: str = "csv") -> int:
    """A4: run a query and export its rows; nothing is written when it has none.

    Returns the number of rows written.
    """
    df = spark.sql(query) if isinstance(query, str) else query
    n = overwrite(df, f"{path}.staged", fmt=fmt)          # the query runs once
    where = spark._jvm.org.apache.hadoop.fs.Path
    fs = where(path).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if n:
        fs.delete(where(path), True)
        fs.rename(where(f"{path}.staged"), where(path))
    else:
        fs.delete(where(f"{path}.staged"), True)
    return n


def overwrite(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = (),
              cluster_by: Sequence[str] = (), num_partitions: int | None = None) -> int:
    """Create-or-replace a dataset and report the rows written.

    ``partition_by`` gives directory partitions (A6); ``cluster_by`` sorts rows
    inside each file.  The shuffle before the write hashes the partition
    *and* clustering keys, so one large date is written by many tasks.
    The rows written are counted on the output, which for Parquet means its footers.
    (Not by an ``Observation``: a session that has used one can't send MLlib's forest
    models to tasks any more.)
    """
    out = df
    if partition_by or cluster_by:
        keys = [*partition_by, *cluster_by]
        out = (out.repartition(num_partitions, *keys) if num_partitions else out.repartition(*keys))
        out = out.sortWithinPartitions(*keys)
    w = out.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        w = w.option("header", True)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
    back = df.sparkSession.read.format(fmt)
    if fmt == "csv":
        back = back.option("header", True).option("multiLine", True)
    return back.schema(out.schema).load(path).count()


def overwrite_table(df: DataFrame, name: str, partition_by: Sequence[str] = (),
                    cluster_by: Sequence[str] = ()) -> None:
    """CREATE OR REPLACE TABLE ... AS (drop-then-create is one step)."""
    out = df
    if partition_by or cluster_by:
        out = out.repartition(*partition_by, *cluster_by).sortWithinPartitions(*partition_by, *cluster_by)
    w = out.write.mode("overwrite").format("parquet")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(name)


def with_date_partition(df: DataFrame, ts: str, name: str = "partition_date") -> DataFrame:
    """The DATE(ts) partition column."""
    return df.withColumn(name, F.to_date(ts))


def write_csv(df: DataFrame, path: str) -> int:
    """CSV with a header; the target folder is created by the writer."""
    return overwrite(df, path, fmt="csv")


def write_report(sheets: dict[str, DataFrame], folder: str, fmt: str = "parquet") -> dict[str, int]:
    """A10: one dataset per sheet name under ``folder``."""
    return {name: overwrite(df, os.path.join(folder, name), fmt=fmt) for name, df in sheets.items()}


def add_sheet(folder: str, name: str, df: DataFrame, fmt: str = "parquet") -> int:
    """Add (or replace) one sheet of an existing report."""
    return overwrite(df, os.path.join(folder, name), fmt=fmt)


def append_registry(df: DataFrame, path: str) -> None:
    """Append rows to a registry dataset (no read-concat-rewrite)."""
    df.write.mode("append").parquet(path)


def write_summary_text(lines: DataFrame, path: str, column: str = "line") -> None:
    """Text summary; one line per row of a single string column."""
    lines.select(F.col(column).cast("string")).coalesce(1).write.mode("overwrite").text(path)


# ---------------------------------------------------------------------------
# inspection
# ---------------------------------------------------------------------------

def shape(df: DataFrame) -> tuple[int, int]:
    """(rows, columns)."""
    return df.count(), len(df.columns)


def head(df: DataFrame, n: int = 5) -> DataFrame:
    """The first ``n`` rows (``LIMIT``)."""
    return df.limit(n)


def date_range(df: DataFrame, col: str) -> DataFrame:
    """Min and max of a date column."""
    return df.agg(F.min(col).alias("min_date"), F.max(col).alias("max_date"))
