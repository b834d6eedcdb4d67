"""Retry-safe sinks: stage, then swap by manifest; registry appends with a job key.

A job writes its rows to a version folder of its own and then names that folder in the
manifest, a small file that is replaced in one step.  Readers follow the manifest, so
they see the old rows or the new ones, never half of them.  A job that is repeated
under its key - after a crash or by a scheduler - writes and adds nothing that is
already there, and doesn't undo what was published since.
"""

from __future__ import annotations

import json
import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ordertide.sources.io import overwrite

MANIFEST = "MANIFEST.json"
_PUBLISHED = "_PUBLISHED"


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _fs(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def _exists(spark: SparkSession, path: str) -> bool:
    return _fs(spark, path).exists(_path(spark, path))


def _read_text(spark: SparkSession, path: str) -> str:
    stream = _fs(spark, path).open(_path(spark, path))
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    stream = _fs(spark, path).create(_path(spark, path), True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def _swap(spark: SparkSession, path: str, text: str, job_id: str) -> None:
    """Put a file in place of another in one step."""
    staged = f"{path}.{job_id}"
    _write_text(spark, staged, text)
    jvm = spark._jvm
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    uri = _fs(spark, path).makeQualified(_path(spark, path))
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(uri.toUri(), spark._jsparkSession.sessionState().newHadoopConf())
    context.rename(_fs(spark, staged).makeQualified(_path(spark, staged)), uri, options)


def _key(job_id: str) -> str:
    if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9._-]*", job_id):
        raise ValueError(f"not a job key: {job_id!r}")
    return job_id


def publish(df: DataFrame, path: str, job_id: str, partition_by: Sequence[str] = (), cluster_by: Sequence[str] = ()) -> int:
    """Replace the dataset at ``path`` by the rows of ``df``; returns the rows of the job's version.

    Half-written versions are written anew; a version that was published before is left
    alone, and so is the manifest."""
    spark, version = df.sparkSession, f"{path}/version-{_key(job_id)}"
    if _exists(spark, f"{version}/{_PUBLISHED}"):
        return json.loads(_read_text(spark, f"{version}/{_PUBLISHED}"))["rows"]
    rows = overwrite(df, version, partition_by=partition_by, cluster_by=cluster_by)
    entry = json.dumps({"version": version.rsplit("/", 1)[1], "rows": rows})
    _swap(spark, f"{path}/{MANIFEST}", entry, job_id)
    _write_text(spark, f"{version}/{_PUBLISHED}", entry)
    return rows


def read_published(spark: SparkSession, path: str) -> DataFrame:
    """The rows that the manifest names."""
    return spark.read.parquet(f"{path}/{json.loads(_read_text(spark, f'{path}/{MANIFEST}'))['version']}")


def append_once(df: DataFrame, path: str, job_id: str) -> bool:
    """Append the rows of a job to a registry, once; says whether this call did.

    A job's rows are a partition of their own (``job_id``): complete ones are kept as
    they are, a half-written one is replaced."""
    part = f"{path}/job_id={_key(job_id)}"
    if _exists(df.sparkSession, f"{part}/_SUCCESS"):
        return False
    df.write.mode("overwrite").parquet(part)
    return True


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """All completed appends; ``job_id`` says which job a row is from."""
    fs = _fs(spark, path)
    parts = [s.getPath().toString() for s in fs.listStatus(_path(spark, path)) if s.isDirectory() and s.getPath().getName().startswith("job_id=")]
    done = [p for p in parts if _exists(spark, f"{p}/_SUCCESS")]
    return spark.read.option("basePath", path).parquet(*done)
