"""Bounded, repeatable samples of labelled rows for the classifiers."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordertide.llm.common import map_arrow, text_bytes


def labelled_sample(docs: DataFrame, labels: DataFrame, label_col: str, train_rows: Column, per_class: int,
                    describe, kind: str, id_col: str = "doc_id", text_col: str = "text") -> list[tuple]:
    """(description, label) of at most ``per_class`` rows of each label 0 and 1.

    ``train_rows`` is a condition on the id column of ``labels``.  Rows are taken by
    smallest hash of their id, so the sample doesn't depend on order or
    partitioning, and texts of every length count.  Tasks turn each chosen text into
    what the model learns from (``describe``, of Spark type ``kind``); only that reaches
    the driver.  Null ids, texts and other labels are left out; an id with
    several labels takes the largest, an id with several texts the first in order."""
    lab = (labels.where(train_rows).select(F.col(id_col).alias("i"), F.col(label_col).cast("int").alias("y"))
           .where("i IS NOT NULL AND y IN (0, 1)").groupBy("i").agg(F.max("y").alias("y")))
    src = docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")).where("i IS NOT NULL AND t IS NOT NULL")
    able = lab.join(src.select("i"), "i")
    picked = []
    for y in (0, 1):
        picked += able.where(F.col("y") == y).distinct().orderBy(F.xxhash64("i", F.lit(17)), "i").limit(per_class).collect()
    if not picked:
        return []
    chosen = src.sparkSession.createDataFrame(picked, able.schema)
    rows = src.join(F.broadcast(chosen), "i")                     # at most 2 * per_class ids
    rows = rows.groupBy("i", "y").agg(F.min("t").alias("t")).select("i", "y", text_bytes(F.col("t")).alias("t"))

    def run(batches):
        for b in batches:
            found = [describe(t.as_py().decode("utf-8", "replace")) for t in b.column(2)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(found, spec)], names=["i", "y", "f"])

    schema = f"i {rows.schema['i'].dataType.simpleString()}, y int, f {kind}"
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType
    spec = to_arrow_schema(StructType.fromDDL(schema)).field("f").type
    return [(r.f, r.y) for r in sorted(map_arrow(rows, run, schema).collect(), key=lambda r: r.i)]
