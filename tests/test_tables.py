"""Table preparation: against pandas, with many levels, saved and loaded."""

import os

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ordertide.operators.tables import TablePreparer, TablePreparerModel, named_entries


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(3)
    rows = [(i, None if i % 7 == 0 else float(rng.integers(0, 9)), float("nan") if i % 11 == 0 else float(rng.normal(50, 9)),
             None if i % 13 == 0 else str(rng.choice(["a", "b", "b", "c", "zz"])), str(rng.choice(["x", "y"])), "clash") for i in range(600)]
    return spark.createDataFrame(rows, "id long, n1 double, n2 double, c1 string, c2 string, features0 string").repartition(4)


def test_equals_pandas(frame):
    pdf = frame.toPandas().sort_values("id")
    want = pdf[["n1", "n2"]].fillna(pdf[["n1", "n2"]].median())
    want = (want - want.mean()) / want.std(ddof=0)
    dummies = pd.get_dummies(pdf[["c1", "c2"]].apply(lambda c: c.fillna(c.mode()[0])), drop_first=True).astype(float)
    model = TablePreparer(numericCols=["n1", "n2"], categoricalCols=["c1", "c2"]).fit(frame)
    out = model.transform(frame)
    assert out.columns == [*frame.columns, "features"] and model.widths() == {"c1": 3, "c2": 1}
    got = np.array([r.f for r in out.orderBy("id").select(vector_to_array("features").alias("f")).collect()])
    np.testing.assert_allclose(got[:, :2], want.to_numpy(), atol=1e-9)
    names = {(r.id, f"{r.column_name}_{r.level}") for r in named_entries(model, out, ["id"]).collect()}
    assert names == {(i, c) for i, row in zip(pdf["id"], dummies.to_dict("records")) for c, v in row.items() if v}


def test_rare_and_unseen_levels(spark, frame):
    model = TablePreparer(numericCols=[], categoricalCols=["c1"], minCount=100, frequencies=True).fit(frame)
    levels = {r.level: r.n for r in model.levels.collect()}
    assert "OTHER" in levels or min(levels.values()) >= 100
    assert sum(levels.values()) == 600
    new = spark.createDataFrame([(1, "never"), (2, None)], "id long, c1 string")
    names = {(r.id, r.level) for r in named_entries(model, model.transform(new), ["id"]).collect()}
    seen = {l for l in levels} - {min(levels)}
    assert names <= {(1, "OTHER"), (2, max(levels, key=lambda l: (levels[l], l)))} and all(l in seen for _, l in names)


def test_fifty_thousand_levels_saved_and_loaded(spark, tmpdir_path):
    """50,000 levels, one of them on a third of the rows: fit, save, load, and score the same."""
    df = spark.range(150_000).select("id", (F.col("id") * 0.5).alias("v"), F.when(F.col("id") % 3 == 0, "hot").otherwise(
        F.concat(F.lit("level "), (F.col("id") % 50_000).cast("string"))).alias("c"))
    model = TablePreparer(numericCols=["v"], categoricalCols=["c"]).fit(df)
    width = model.widths()["c"]
    assert width == df.select("c").distinct().count() - 1 > 49_000
    path = os.path.join(tmpdir_path, "model")
    model.write().save(path)
    again = TablePreparerModel.load(path)
    assert again.widths() == {"c": width} and again.getOrDefault("numericCols") == ["v"]
    some = df.filter("id % 5000 < 3")
    one = {r.id: r.features for r in model.transform(some).collect()}
    two = {r.id: r.features for r in again.transform(some).collect()}
    assert one == two and len(one) == some.count()
    assert all(v.size == width + 1 and len(v.indices) <= 2 for v in two.values() if hasattr(v, "indices"))
    hot = [v for i, v in two.items() if i % 3 == 0]
    assert len({tuple(int(k) for k in v.indices if k > 0) for v in hot}) == 1
    with pytest.raises(Exception):
        model.write().save(path)                     # nothing is overwritten unasked
    model.write().overwrite().save(path)


def test_empty_and_constant(spark, frame):
    model = TablePreparer(numericCols=["n1"], categoricalCols=["c1"]).fit(frame.limit(0))
    assert model.transform(frame.limit(0)).count() == 0
    one = spark.createDataFrame([(1, 5.0, "a"), (2, 5.0, "a")], "id long, n1 double, c1 string")
    model = TablePreparer(numericCols=["n1"], categoricalCols=["c1"]).fit(one)
    assert [list(r.features) for r in model.transform(one).collect()] == [[0.0], [0.0]]


def test_hybrid_encoder_keeps_its_levels(spark, frame, tmpdir_path):
    from ordertide.operators.prep import HybridEncoder, HybridEncoderModel
    model = HybridEncoder(inputCol="c1", minCount=90, dropFirst=False).fit(frame)
    path = os.path.join(tmpdir_path, "hybrid")
    model.write().save(path)
    again = HybridEncoderModel.load(path)
    assert (again.col, again.drop_first, again.frequent, again.lvls, again.counts) == (model.col, model.drop_first, model.frequent, model.lvls, model.counts)
    assert sorted(map(str, again.transform(frame).collect())) == sorted(map(str, model.transform(frame).collect()))
