"""Study pipelines K14-K17, composed of the profiling, preparation, statistics
and model operators.  Each returns small result tables; the data stay in
Spark throughout."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordertide.operators import ml as M
from ordertide.operators import prep as X
from ordertide.operators import profile as P
from ordertide.operators import stats as S


def regression_study(df: DataFrame, target: str, groups: Sequence[Sequence[str]],
                     final: Sequence[str]) -> dict[str, DataFrame]:
    """Profile -> VIF -> stepwise logits -> final model with odds ratios
    and marginal effects joined on the term name (C25j)."""
    spark = df.sparkSession
    with S.kept(df) as d:
        return _regression_tables(d, target, groups, final, spark)


def _regression_tables(d: DataFrame, target: str, groups, final, spark) -> dict[str, DataFrame]:
    feats = sorted({c for g in groups for c in g} | set(final))
    model, _ = S.fit_logit(d, target, list(final))
    coef = S.logit_table(model, list(final), spark)
    me = S.marginal_effects(model, d, list(final))
    return {
        "missing": P.missing_profile(d, [*feats, target]),
        "vif": S.vif(d, feats, intercept=False),
        "stepwise": S.stepwise_logits(d, target, groups),
        "coefficients": coef,
        "margins": me,
        "or_me": coef.select("term", "odds_ratio", "p_value").join(
            me.select("term", "ame", F.col("p_value").alias("ame_p_value")), "term", "left"),
        "stats": S.logit_stats(model, spark),
    }


def multicollinearity_reduction(train: DataFrame, test: DataFrame, keys: Sequence[str], cols: Sequence[str],
                                threshold: float = 10.0, intercept: bool = True):
    """K15 (J5 + J6): keep features with VIF <= threshold, replace the rest by
    their principal components (fitted on train, applied to both), recompute
    VIF, and compare before / after, by kind of variable.  Returns (train, test,
    comparison, replaced variables)."""
    before = S.vif(train, cols, intercept)
    rows = before.collect()
    low = [r.feature for r in rows if r.vif <= threshold]
    high = [r.feature for r in rows if not (r.vif <= threshold)]
    keep = [*keys, *low]
    if high:
        model = S.fit_pca(train, high)
        tr, te = S.pca_scores(model, train, keep), S.pca_scores(model, test, keep)
        pcs = [c for c in tr.columns if c.startswith("multicollinearity_PC")]
    else:
        tr, te, pcs = train.select(*keep), test.select(*keep), []
    after = S.vif(tr, [*low, *pcs], intercept)

    value = {r.feature: r.vif for r in rows}

    def summary(v: DataFrame, stage: str, kind: str) -> DataFrame:
        return v.agg(F.lit(stage).alias("stage"), F.lit(kind).alias("kind"), F.count(F.lit(1)).alias("n_features"),
                     F.count_if(F.col("vif") > threshold).alias("n_above_threshold"),
                     F.round(F.avg(F.when(F.col("vif") != float("inf"), F.col("vif"))), 6).alias("mean_vif"),
                     F.round(F.max("vif"), 6).alias("max_vif"))
    comparison = summary(before, "before", "all").unionByName(summary(after, "after", "all"))
    for kind, own in (("kept features", low), ("components", pcs)):
        comparison = comparison.unionByName(summary(after.filter(F.col("feature").isin(own)), "after", kind))
    # the variables that components stand for, the worst first
    span = f"{pcs[0]} to {pcs[-1]}" if pcs else ""
    replaced = train.sparkSession.createDataFrame(
        [(f, float(value[f]), span) for f in sorted(high, key=lambda f: -value[f])], "removed_feature string, original_vif double, replaced_by string")
    return tr, te, comparison, replaced


def feature_selection_consensus(df: DataFrame, target: str, cols: Sequence[str], n_keep_rfe: int = 30,
                                trees: int = 100) -> DataFrame:
    """Six selectors (variance, ANOVA F, binned MI, forest importance,
    RFE, L1) scaled by their maxima, averaged and ranked."""
    with S.kept(df) as d:
        return S.consensus(_selector_scores(d, target, list(cols), n_keep_rfe, trees))


def _selector_scores(d: DataFrame, target: str, cols: list[str], n_keep_rfe: int, trees: int) -> dict[str, DataFrame]:
    scores = {
        "variance": S.variance_filter(d, cols).select("feature", F.col("selected").cast("double").alias("score")),
        "anova": S.anova_f(d, target, cols).select("feature", F.col("f_score").alias("score")),
        "mi": S.binned_mutual_info(d, target, cols).select("feature", F.col("mutual_info").alias("score")),
        "rf": S.rf_importance(d, target, cols, trees=trees).select("feature", F.col("importance").alias("score")),
        "l1": S.l1_selection(d, target, cols, 0.1).select("feature", F.col("selected").cast("double").alias("score")),
    }
    ranks = S.rfe(d, target, cols, min(n_keep_rfe, len(cols)))
    last = ranks.agg(F.max("rfe_rank")).first()[0]
    scores["rfe"] = ranks.select("feature", (F.lit(last) - F.col("rfe_rank") + 1.0).alias("score"))
    return scores


def classifier_study(df: DataFrame, label: str, numeric: Sequence[str], categorical: str, ts: str,
                     key: Sequence[str], min_count: int = 100, fit_on: str = "train",
                     n_trials: int = 10) -> DataFrame:
    """Impute -> time split -> hybrid encoding -> scaling -> tuned forest ->
    evaluation on the test part (report, precision@20 %, average precision).

    ``fit_on="train"`` fits imputation and scaling on the training rows only;
    ``fit_on="all"`` reproduces the reference, which fitted them before the split.
    """
    split = X.time_split(df, ts, list(key), 0.8).persist(StorageLevel.MEMORY_AND_DISK)
    fit_rows = split.filter(F.col("split") == "train") if fit_on == "train" else split
    filled = X.fill(split, X.fit_medians(fit_rows, list(numeric)))
    enc = X.HybridEncoder(inputCol=categorical, minCount=min_count).fit(filled.filter(F.col("split") == "train"))
    coded = enc.transform(filled)
    onehot = [c for c in coded.columns if c.startswith(f"{categorical}_") and c not in
              (f"{categorical}_count", f"{categorical}_freq")]
    scaled = X.standardise(coded, X.fit_standardiser(
        coded.filter(F.col("split") == "train") if fit_on == "train" else coded, list(numeric)))
    feats = [*numeric, f"{categorical}_freq", *onehot]
    train = scaled.filter(F.col("split") == "train").fillna(0.0, feats)
    test = scaled.filter(F.col("split") == "test").fillna(0.0, feats)
    est, space, scorer = M.model_factory("random_forest", label=label)
    cv = M.cv_search(train, label, feats, est, space, scorer, n_trials=n_trials)
    scored = M.score_batch(cv.bestModel, test, feats)
    report = M.classification_report(scored, label, "prediction")
    pk = M.precision_recall_at_k(scored.select(*key, label, "score"), label, "score", [0.2]).first()
    ap = M.average_precision(M.pr_curve(scored, label, "score")).first()[0]
    spark = df.sparkSession
    extra = spark.createDataFrame([("precision_at_20pct", float(pk.precision_at_k), None, None, int(pk.k)),
                                   ("average_precision", float(ap), None, None, None)], report.schema)
    return report.unionByName(extra)
