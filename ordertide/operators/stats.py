"""

The data pass of every statistic is a Spark aggregation (cross products,
class moments, binned counts) or an MLlib estimator; only p x p matrices and
per-feature score tables reach the driver, where NumPy does the linear
algebra.  VIF, for example, is one Gramian (``operators.gram``) and one inverse
instead of one regression per column.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from contextlib import contextmanager

import numpy as np
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GeneralizedLinearRegression
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordertide.operators.gram import Moments, moments
from ordertide.operators.quantiles import quantile_rows


@contextmanager
def kept(df: DataFrame):
    """``df`` persisted while something rescans it."""
    d = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield d
    finally:
        d.unpersist()


# ---------------------------------------------------------------------------
# VIF from the moment matrix
# ---------------------------------------------------------------------------

def _inv(m: np.ndarray) -> tuple[np.ndarray, bool]:
    try:
        if np.linalg.cond(m) > 1e12:
            raise np.linalg.LinAlgError
        return np.linalg.inv(m), True
    except np.linalg.LinAlgError:
        return np.linalg.pinv(m), False


def vif_from_moments(m: Moments, intercept: bool) -> np.ndarray:
    """VIF per column from the moments.

    ``intercept=False`` (J1): uncentred, VIF_j = (X'X)_jj * ((X'X)^-1)_jj.
    ``intercept=True`` (J2): centred, VIF_j = diag(inv(R))_j for the
    correlation matrix R.  A singular matrix gives ``inf`` for the columns
    it involves.
    """
    g = m.centred if intercept else m.gram()
    sd = np.sqrt(np.clip(np.diag(g), 0, None))
    const = sd == 0
    with np.errstate(divide="ignore", invalid="ignore"):
        r = np.where(np.outer(const, const) | (np.outer(sd, sd) == 0), 0.0, g / np.outer(sd, sd))
    inv, ok = _inv(r)                      # scaled to a unit diagonal: both forms are diag(inv(R))
    out = np.diag(inv).copy()
    if not ok:
        out = np.where(np.abs(out) > 1e10, np.inf, out)
    out[const] = np.inf
    return out


def vif(df: DataFrame, cols: Sequence[str], intercept: bool = True) -> DataFrame:
    """VIF table (feature, vif) from one Gramian."""
    v = vif_from_moments(moments(df, cols), intercept)
    spark = df.sparkSession
    return spark.createDataFrame([(c, float(x)) for c, x in zip(cols, v)], "feature string, vif double")


def vif_reduce(df: DataFrame, cols: Sequence[str], drop: Sequence[str] = (), threshold: float = 10.0,
               intercept: bool = False) -> tuple[list[str], DataFrame]:
    """Drop the listed columns, then repeatedly the one with the largest
    VIF until all are below ``threshold``; submatrices of one X'X, no rescans."""
    cols = list(cols)
    m = moments(df, cols)
    keep = [c for c in cols if c not in set(drop)]
    while True:
        v = vif_from_moments(m.of([cols.index(c) for c in keep]), intercept)
        worst = int(np.argmax(v))
        if len(keep) <= 1 or v[worst] < threshold:
            break
        keep.pop(worst)
    rows = [(c, float(x)) for c, x in zip(keep, v)]
    return keep, df.sparkSession.createDataFrame(rows, "feature string, vif double")


def vif_summary(vifs: DataFrame) -> DataFrame:
    """Counts in the >= 5 / 10 / 20 bands, mean, median, max (+ feature), min."""
    fin = F.when(~F.isnan("vif") & (F.col("vif") != float("inf")), F.col("vif"))
    return vifs.agg(
        F.count(F.lit(1)).alias("n_features"),
        F.count_if(F.col("vif") >= 5).alias("n_vif_ge_5"),
        F.count_if(F.col("vif") >= 10).alias("n_vif_ge_10"),
        F.count_if(F.col("vif") >= 20).alias("n_vif_ge_20"),
        F.round(F.avg(fin), 6).alias("mean_vif"),
        F.round(F.median(fin), 6).alias("median_vif"),
        F.round(F.max("vif"), 6).alias("max_vif"),
        F.max_by("feature", "vif").alias("max_vif_feature"),
        F.round(F.min("vif"), 6).alias("min_vif"))


# ---------------------------------------------------------------------------
# PCA (J7-J10)
# ---------------------------------------------------------------------------

def fit_pca(train: DataFrame, cols: Sequence[str], k: int | None = None):
    """Centred (not scaled) PCA with all (or ``k``) components.

    ``ml.PCA`` does not centre, so a mean-only ``StandardScaler`` runs first;
    the fitted pipeline applies the *training* means to any later frame (J9).
    """
    k = k or len(cols)
    pipe = Pipeline(stages=[
        VectorAssembler(inputCols=list(cols), outputCol="__x", handleInvalid="skip"),
        StandardScaler(inputCol="__x", outputCol="__xc", withMean=True, withStd=False),
        PCA(k=k, inputCol="__xc", outputCol="__pcs"),
    ])
    return pipe.fit(train)


def pca_variance(model, spark: SparkSession) -> DataFrame:
    """Explained and cumulative variance ratio per component."""
    ev = model.stages[-1].explainedVariance.toArray()
    cum = np.cumsum(ev)
    rows = [(i + 1, float(e), float(c)) for i, (e, c) in enumerate(zip(ev, cum))]
    return spark.createDataFrame(rows, "component int, explained_variance double, cumulative_variance double")


def pca_levels(model, n_features: int, spark: SparkSession, levels: Sequence[float] = (0.5, 0.8, 0.9, 0.95, 0.99)) -> DataFrame:
    """Per level of explained variance the fewest components that reach it, and by how much
    (%) they are fewer than the features."""
    cum = np.cumsum(model.stages[-1].explainedVariance.toArray())
    need = [int(np.searchsorted(cum, lv - 1e-12) + 1) for lv in levels]
    return spark.createDataFrame([(float(lv), k, round(100.0 * (1 - k / n_features), 4)) for lv, k in zip(levels, need)],
                                 "variance_level double, components int, reduction_pct double")


def pca_scores(model, df: DataFrame, keep: Sequence[str], prefix: str = "multicollinearity_PC") -> DataFrame:
    """Apply the fitted PCA; components as columns ``{prefix}{i}``."""
    k = model.stages[-1].getK()
    out = model.transform(df).withColumn("__arr", vector_to_array("__pcs"))
    return out.select(*keep, *[F.col("__arr")[i].alias(f"{prefix}{i + 1}") for i in range(k)])


# ---------------------------------------------------------------------------
# logistic regression tables
# ---------------------------------------------------------------------------

def _norm_sf(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2.0))


def _gammaincc(a: float, x: float) -> float:
    """Regularised upper incomplete gamma Q(a, x) (series / continued fraction)."""
    if x <= 0:
        return 1.0
    lg = math.lgamma(a)
    if x < a + 1:
        term = total = 1.0 / a
        ap = a
        for _ in range(10_000):
            ap += 1
            term *= x / ap
            total += term
            if abs(term) < abs(total) * 1e-15:
                break
        return max(0.0, 1.0 - total * math.exp(-x + a * math.log(x) - lg))
    b, c, d = x + 1 - a, 1e300, 1.0 / (x + 1 - a)
    h = d
    for i in range(1, 10_000):
        an = -i * (i - a)
        b += 2
        d = an * d + b
        d = 1e-300 if abs(d) < 1e-300 else d
        c = b + an / c
        c = 1e-300 if abs(c) < 1e-300 else c
        d = 1.0 / d
        h *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return math.exp(-x + a * math.log(x) - lg) * h


def chi2_sf(x: float, k: int) -> float:
    return _gammaincc(k / 2.0, x / 2.0)


def fit_logit(df: DataFrame, target: str, cols: Sequence[str], max_iter: int = 100):
    """Binomial GLM with logit link and intercept (IRLS in MLlib)."""
    d = VectorAssembler(inputCols=list(cols), outputCol="__x", handleInvalid="skip").transform(df)
    glm = GeneralizedLinearRegression(family="binomial", link="logit", featuresCol="__x", labelCol=target,
                                      maxIter=max_iter, fitIntercept=True)
    with kept(d) as d:                            # IRLS rescans the input every iteration
        return glm.fit(d), d


def logit_table(model, cols: Sequence[str], spark: SparkSession) -> DataFrame:
    """J11 + J17: coefficient, std error, z, p, 95 % CI, odds ratio and CI per term."""
    s = model.summary
    coef = list(model.coefficients) + [model.intercept]
    se, zs, ps = s.coefficientStandardErrors, s.tValues, s.pValues
    names = list(cols) + ["const"]
    rows = []
    for n, b, e, z, p in zip(names, coef, se, zs, ps):
        lo, hi = b - 1.959963984540054 * e, b + 1.959963984540054 * e
        rows.append((n, float(b), float(e), float(z), float(p), float(lo), float(hi),
                     float(math.exp(b)), float(math.exp(lo)), float(math.exp(hi))))
    return spark.createDataFrame(rows, "term string, coef double, std_err double, z double, p_value double, "
                                       "ci_low double, ci_high double, odds_ratio double, or_ci_low double, "
                                       "or_ci_high double").orderBy("term")


def logit_stats(model, spark: SparkSession, max_iter: int = 100) -> DataFrame:
    """N, df, log-likelihoods, McFadden R2, AIC, BIC, LLR p, convergence."""
    s = model.summary
    n = s.numInstances
    k = len(model.coefficients) + 1
    ll, ll0 = -s.deviance / 2.0, -s.nullDeviance / 2.0
    llr = 2 * (ll - ll0)
    row = (int(n), int(s.residualDegreeOfFreedom), int(k - 1), float(ll), float(ll0),
           float(1 - ll / ll0) if ll0 else None, float(s.aic), float(k * math.log(n) - 2 * ll),
           float(chi2_sf(llr, k - 1)), bool(s.numIterations < max_iter), int(s.numIterations))
    return spark.createDataFrame([row], "n_obs bigint, df_resid bigint, df_model bigint, log_likelihood double, "
                                        "ll_null double, pseudo_r2 double, aic double, bic double, "
                                        "llr_p_value double, converged boolean, iterations bigint")


def marginal_effects(model, df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Average marginal effects with delta-method standard errors.

    One pass gives mean(p(1-p)), the means of p(1-p)(1-2p)x_k (the Jacobian)
    and X'WX with W = p(1-p) (the coefficient covariance), all as Spark
    aggregates over the predictions.
    """
    cols = list(cols)
    beta = np.array(list(model.coefficients))
    b0 = model.intercept
    eta = sum((F.lit(float(b)) * F.col(c) for b, c in zip(beta, cols)), F.lit(float(b0)))
    p = 1 / (1 + F.exp(-eta))
    d = df.dropna(subset=cols).withColumn("__p", p).withColumn("__w", F.col("__p") * (1 - F.col("__p")))
    xs = [*cols, "__one"]
    d = d.withColumn("__one", F.lit(1.0))
    xtwx = moments(d, xs, weight="__w").gram()
    m = d.agg(F.avg("__w").alias("mw"),
              *[F.avg(F.col("__w") * (1 - 2 * F.col("__p")) * F.col(c)).alias(f"j{i}")
                for i, c in enumerate(xs)]).first()
    cov = np.linalg.pinv(xtwx)
    mw = m["mw"]
    jv = np.array([m[f"j{i}"] for i in range(len(xs))])
    rows = []
    coef_all = np.append(beta, b0)
    for j, c in enumerate(cols):
        grad = coef_all[j] * jv
        grad[j] += mw
        ame = coef_all[j] * mw
        se = float(math.sqrt(max(grad @ cov @ grad, 0.0)))
        z = ame / se if se else float("nan")
        rows.append((c, float(ame), se, float(z), float(2 * _norm_sf(abs(z))) if se else None))
    return df.sparkSession.createDataFrame(rows, "term string, ame double, std_err double, z double, "
                                                 "p_value double").orderBy("term")


def ame_shortcut(model, df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """AME approximated by beta * mean(p(1-p))."""
    eta = sum((F.lit(float(b)) * F.col(c) for b, c in zip(model.coefficients, cols)), F.lit(model.intercept))
    p = 1 / (1 + F.exp(-eta))
    mw = df.dropna(subset=list(cols)).agg(F.avg(p * (1 - p))).first()[0]
    rows = [(c, float(b) * mw) for b, c in zip(model.coefficients, cols)]
    return df.sparkSession.createDataFrame(rows, "term string, ame double")


def stepwise_logits(df: DataFrame, target: str, groups: Sequence[Sequence[str]]) -> DataFrame:
    """Cumulative groups of features, one model per step, stats per step."""
    spark = df.sparkSession
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    out, used = [], []
    for i, g in enumerate(groups, 1):
        used = used + [c for c in g if c not in used]
        model, _ = fit_logit(df, target, used)
        st = logit_stats(model, spark).first()
        out.append((i, len(used), st["log_likelihood"], st["pseudo_r2"], st["aic"], st["bic"]))
    df.unpersist()
    return spark.createDataFrame(out, "step int, n_features int, log_likelihood double, pseudo_r2 double, "
                                      "aic double, bic double")


# ---------------------------------------------------------------------------
# feature scores
# ---------------------------------------------------------------------------

def variance_filter(df: DataFrame, cols: Sequence[str], threshold: float = 0.01) -> DataFrame:
    """Population variance per feature and whether it passes the threshold."""
    one = df.agg(*[F.var_pop(c).alias(c) for c in cols]).first()
    rows = [(c, float(one[c]), bool(one[c] > threshold)) for c in cols]
    return df.sparkSession.createDataFrame(rows, "feature string, variance double, selected boolean")


def anova_f(df: DataFrame, target: str, cols: Sequence[str]) -> DataFrame:
    """One-way ANOVA F per feature from per-class count / sum / sum of squares."""
    g = df.groupBy(target).agg(F.count(F.lit(1)).alias("__n"),
                               *[e for c in cols for e in (F.sum(c).alias(f"{c}__s"),
                                                          F.sum(F.col(c) * F.col(c)).alias(f"{c}__ss"))]).collect()
    rows = []
    k = len(g)
    n = sum(r["__n"] for r in g)
    for c in cols:
        tot_s = sum(r[f"{c}__s"] for r in g)
        tot_ss = sum(r[f"{c}__ss"] for r in g)
        ssb = sum(r[f"{c}__s"] ** 2 / r["__n"] for r in g) - tot_s ** 2 / n
        ssw = tot_ss - sum(r[f"{c}__s"] ** 2 / r["__n"] for r in g)
        f = (ssb / (k - 1)) / (ssw / (n - k)) if ssw > 0 and k > 1 else float("nan")
        rows.append((c, float(f)))
    return df.sparkSession.createDataFrame(rows, "feature string, f_score double")


def binned_mutual_info(df: DataFrame, target: str, cols: Sequence[str], bins: int = 10) -> DataFrame:
    """J20 (re-aimed): mutual information (nats) between quantile-binned
    features and a binary target, from ``groupBy(feature, bin, label).count``."""
    qs = [i / bins for i in range(1, bins)]
    cuts = quantile_rows(df, cols, qs)
    parts = []
    for c in cols:
        edges = sorted({x for x in cuts[c] if x is not None})
        b = sum((F.when(F.col(c) > e, 1).otherwise(0) for e in edges), F.lit(0))
        parts.append(F.struct(F.lit(c).alias("feature"), b.alias("bin")))
    long = df.select(F.col(target).alias("y"), F.explode(F.array(*parts)).alias("f")).select("f.*", "y")
    cnt = long.groupBy("feature", "bin", "y").agg(F.count(F.lit(1)).alias("n"))
    from pyspark.sql import Window
    wf = Window.partitionBy("feature")
    c2 = cnt.withColumns({
        "total": F.sum("n").over(wf),          # column names differ in more than case
        "nb": F.sum("n").over(Window.partitionBy("feature", "bin")),
        "ny": F.sum("n").over(Window.partitionBy("feature", "y")),
    })
    term = (F.col("n") / F.col("total")) * F.log(F.col("n") * F.col("total") / (F.col("nb") * F.col("ny")))
    return c2.groupBy("feature").agg(F.sum(term).alias("mutual_info"))


def rf_importance(df: DataFrame, target: str, cols: Sequence[str], trees: int = 100, seed: int = 42) -> DataFrame:
    """Random-forest impurity importance per feature."""
    d = VectorAssembler(inputCols=list(cols), outputCol="__x", handleInvalid="skip").transform(df)
    m = RandomForestClassifier(featuresCol="__x", labelCol=target, numTrees=trees, seed=seed).fit(d)
    imp = m.featureImportances.toArray()
    return df.sparkSession.createDataFrame([(c, float(v)) for c, v in zip(cols, imp)],
                                           "feature string, importance double")


def rfe(df: DataFrame, target: str, cols: Sequence[str], n_keep: int, step: int = 1, c: float = 1.0) -> DataFrame:
    """Recursive elimination with L2 logistic regression (smallest |coef| out).

    Kept features have rank 1, those eliminated last rank 2, and so on back to the
    first elimination."""
    d = df.persist(StorageLevel.MEMORY_AND_DISK)
    reg = 1.0 / (c * max(1, d.count()))
    keep, rounds = list(cols), []
    while len(keep) > n_keep:
        x = VectorAssembler(inputCols=keep, outputCol="__x", handleInvalid="skip").transform(d)
        m = LogisticRegression(featuresCol="__x", labelCol=target, maxIter=100, regParam=reg, elasticNetParam=0.0,
                               standardization=False).fit(x)
        out = np.argsort(np.abs(m.coefficients.toArray()))[:min(step, len(keep) - n_keep)]
        rounds.append([keep[i] for i in out])
        keep = [f for f in keep if f not in rounds[-1]]
    d.unpersist()
    ranks = [(f, 1) for f in keep] + [(f, 2 + k) for k, own in enumerate(reversed(rounds)) for f in own]
    return df.sparkSession.createDataFrame(ranks, "feature string, rfe_rank int")


def l1_selection(df: DataFrame, target: str, cols: Sequence[str], c: float = 0.1) -> DataFrame:
    """L1 logistic regression, C -> regParam = 1 / (C n); non-zero coefficients."""
    x = VectorAssembler(inputCols=list(cols), outputCol="__x", handleInvalid="skip").transform(df)
    with kept(x) as x:                            # L-BFGS / OWL-QN rescans the input
        n = x.count()
        m = LogisticRegression(featuresCol="__x", labelCol=target, elasticNetParam=1.0, regParam=1.0 / (c * n),
                               standardization=False, maxIter=200).fit(x)
    coef = m.coefficients.toArray()
    return df.sparkSession.createDataFrame([(f, float(v), bool(v != 0)) for f, v in zip(cols, coef)],
                                           "feature string, coef double, selected boolean")


def consensus(scores: dict[str, DataFrame]) -> DataFrame:
    """Each score scaled by its maximum, averaged over methods, all features ranked.

    Score tables are joined on the feature *name* (not by position).
    """
    it = iter(scores.items())
    name, first = next(it)
    acc = first.select("feature", F.col("score").alias(name))
    for name, sdf in it:
        acc = acc.join(sdf.select("feature", F.col("score").alias(name)), "feature", "full")
    methods = list(scores)
    mx = acc.agg(*[F.max(F.abs(F.col(m))).alias(m) for m in methods]).first()
    scaled = [F.coalesce(F.abs(F.col(m)) / F.lit(mx[m] or 1.0), F.lit(0.0)) for m in methods]
    acc = acc.withColumn("consensus_score", sum(scaled, F.lit(0.0)) / len(methods))
    from pyspark.sql import Window
    return acc.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("consensus_score"), "feature")))
