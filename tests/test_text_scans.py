"""Statistics on text features go through the texts once, however often they rescan the features."""

import random

import pytest
from pyspark.sql import functions as F

from ordertide import catalog


@pytest.mark.parametrize("name", ["vif_centred", "vif_uncentred", "logit_margins", "multicollinearity_reduction", "replaced_features"])
def test_text_features_are_made_once(spark, monkeypatch, name):
    catalog.load_all()
    from ordertide.catalog import models
    rnd = random.Random(3)
    cols = [*models.FEATURES, "is_en"]
    rows = [(i, *[float(rnd.randrange(50)) for _ in models.FEATURES], float(i % 2), int(rnd.random() < 0.5), 0) for i in range(120)]
    made = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def counted(x):
        made.add(1)
        return x

    frame = spark.createDataFrame(rows, "doc_id long, " + ", ".join(f"{c} double" for c in cols) + ", quality int, toxic int")
    frame = frame.withColumn("n_chars", F.col("n_lines") + F.col("n_digits") + F.col("is_en"))      # nearly collinear
    frame = frame.withColumn("n_words", counted.asNondeterministic()("n_words"))
    monkeypatch.setattr(models, "doc_features", lambda *a, **k: frame)
    assert catalog.REGISTRY[name](spark, "").count() > 0
    assert made.value == len(rows)


def test_runs_are_removed_as_single_characters_were(spark, tmpdir_path):
    from ordertide.catalog.models import doc_features
    texts = ["", "12 ab34, Äb.C!\n\nXY", "????", "a1b2C3", None]
    spark.createDataFrame([(i, t, "en", len(t or "")) for i, t in enumerate(texts)], "doc_id long, text string, lang string, n_chars long").write.parquet(
        f"{tmpdir_path}/documents.parquet")
    spark.createDataFrame([(0, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmpdir_path}/labels.parquet")
    got = {r.doc_id: (r.n_digits, r.n_upper, r.n_punct) for r in doc_features(spark, tmpdir_path, labelled=False).collect()}
    count = lambda t, s: float(sum(c in s for c in t))
    assert got == {i: (None,) * 3 if t is None else (count(t, "0123456789"), count(t, "ABCDEFGHIJKLMNOPQRSTUVWXYZ"), count(t, ".,;:!?"))
                   for i, t in enumerate(texts)}
