"""Statistics and model queries (J1-J39) on labels x documents and embeddings.

Text features are computed over whole texts with built-in string functions.
Model fits (GLM, PCA, forests) are checked rows-only plus unit tests against
NumPy; exact oracles exist for VIF with two features, ANOVA F, variances and
every ranking metric (the score is a ratio of integer counts, so both engines
produce identical doubles).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ordertide.catalog import query, table
from ordertide.operators import ml as M
from ordertide.operators import stats as S

FEATURES = ["n_chars", "n_words", "n_lines", "n_digits", "n_upper", "n_punct"]


def doc_features(spark, sf, labelled=True):
    """Text counts, language flag and targets per document; without ``labelled`` also
    for documents that have no label (targets NULL)."""
    d = table(spark, sf, "documents")
    t = F.col("text")
    # what isn't counted is removed by whole runs: a match per run, not one per character
    f = d.select(
        "doc_id",
        F.col("n_chars").cast("double").alias("n_chars"),
        F.size(F.split(t, r"\s+")).cast("double").alias("n_words"),
        F.size(F.split(t, "\n")).cast("double").alias("n_lines"),
        F.length(F.regexp_replace(t, "[^0-9]+", "")).cast("double").alias("n_digits"),
        F.length(F.regexp_replace(t, "[^A-Z]+", "")).cast("double").alias("n_upper"),
        F.length(F.regexp_replace(t, "[^.,;:!?]+", "")).cast("double").alias("n_punct"),
        (F.col("lang") == "en").cast("double").alias("is_en"))
    lab = table(spark, sf, "labels")
    return f.join(lab, "doc_id", "inner" if labelled else "left")


_SQL_FEATURES = r"""
f AS (SELECT d.doc_id, CAST(d.n_chars AS DOUBLE) AS n_chars,
             CAST(len(regexp_split_to_array(d.text, '\s+')) AS DOUBLE) AS n_words,
             CAST(len(string_split(d.text, chr(10))) AS DOUBLE) AS n_lines,
             CAST(length(regexp_replace(d.text, '[^0-9]', '', 'g')) AS DOUBLE) AS n_digits,
             CAST(length(regexp_replace(d.text, '[^A-Z]', '', 'g')) AS DOUBLE) AS n_upper,
             CAST(length(regexp_replace(d.text, '[^.,;:!?]', '', 'g')) AS DOUBLE) AS n_punct,
             l.quality, l.toxic
      FROM documents d JOIN labels l ON l.doc_id = d.doc_id)
"""
_SQL_ALL_FEATURES = _SQL_FEATURES.replace("documents d JOIN", "documents d LEFT JOIN")


@query("doc_features", oracle="WITH " + _SQL_ALL_FEATURES + "SELECT * FROM f")
def doc_features_q(spark, sf):
    return doc_features(spark, sf, labelled=False).drop("is_en")


# --------------------------------------------------------------------------
# VIF
# --------------------------------------------------------------------------

@query("vif_pair_centred", oracle="WITH " + _SQL_ALL_FEATURES + """
SELECT 'n_words' AS feature, round(1 / (1 - corr(n_words, n_punct) ^ 2), 6) AS vif FROM f
UNION ALL SELECT 'n_punct', round(1 / (1 - corr(n_words, n_punct) ^ 2), 6) FROM f
""")
def vif_pair_centred(spark, sf):
    """J2 with two features: equals 1 / (1 - r^2)."""
    v = S.vif(doc_features(spark, sf, labelled=False), ["n_words", "n_punct"], intercept=True)
    return v.withColumn("vif", F.round("vif", 6))


@query("vif_centred")
def vif_centred(spark, sf):
    return S.vif(doc_features(spark, sf, labelled=False), FEATURES, intercept=True)


@query("vif_uncentred")
def vif_uncentred(spark, sf):
    return S.vif(doc_features(spark, sf, labelled=False), FEATURES, intercept=False)


@query("vif_reduction")
def vif_reduction(spark, sf):
    """J4 + J3: drop n_chars, then the worst until all VIF < 10; summary."""
    _, table_ = S.vif_reduce(doc_features(spark, sf, labelled=False), FEATURES, drop=["n_chars"], threshold=10.0)
    return S.vif_summary(table_)


# --------------------------------------------------------------------------
# PCA on embeddings
# --------------------------------------------------------------------------

def _embedding_cols(spark, sf):
    e = table(spark, sf, "embeddings")
    dim = e.select(F.size("embedding")).first()[0]
    cols = [f"e{i}" for i in range(dim)]
    return e.select("vec_id", "label", *[F.col("embedding")[i].cast("double").alias(c)
                                         for i, c in enumerate(cols)]), cols


@query("pca_variance")
def pca_variance(spark, sf):
    """J7 + J8: all components, explained and cumulative variance."""
    e, cols = _embedding_cols(spark, sf)
    return S.pca_variance(S.fit_pca(e, cols), spark)


@query("pca_levels")
def pca_levels(spark, sf):
    """Components needed per level of explained variance, and the reduction."""
    e, cols = _embedding_cols(spark, sf)
    return S.pca_levels(S.fit_pca(e, cols), len(cols), spark)


@query("replaced_features")
def replaced_features(spark, sf):
    """The variables that components replace, with their VIF."""
    from ordertide.plans.studies import multicollinearity_reduction as reduce_
    with S.kept(doc_features(spark, sf, labelled=False)) as d:
        train, test = d.filter(F.col("doc_id") % 5 != 0), d.filter(F.col("doc_id") % 5 == 0)
        return reduce_(train, test, ["doc_id"], FEATURES, threshold=10.0)[3]


@query("pca_scores")
def pca_scores(spark, sf):
    """J9 + J10: fit on the train split (by vec_id), apply to all rows, 4 components."""
    from ordertide.operators.prep import time_split
    e, cols = _embedding_cols(spark, sf)
    e = e.withColumn("__t", F.timestamp_seconds("vec_id"))
    split = time_split(e, "__t", ["vec_id"], 0.8)
    model = S.fit_pca(split.filter(F.col("split") == "train"), cols, k=4)
    return S.pca_scores(model, split, ["vec_id", "label", "split"])


# --------------------------------------------------------------------------
# Logit study
# --------------------------------------------------------------------------

LOGIT = ["n_words", "n_lines", "n_digits", "n_upper", "n_punct", "is_en"]


@query("logit_table")
def logit_table(spark, sf):
    """J11 + J17: coefficients, errors, p-values, CIs and odds ratios."""
    d = doc_features(spark, sf)
    model, _ = S.fit_logit(d, "quality", LOGIT)
    return S.logit_table(model, LOGIT, spark)


@query("logit_margins")
def logit_margins(spark, sf):
    """Average marginal effects with delta-method errors."""
    with S.kept(doc_features(spark, sf)) as d:
        model, _ = S.fit_logit(d, "quality", LOGIT)
        return S.marginal_effects(model, d, LOGIT)


@query("logit_margins_shortcut")
def logit_margins_shortcut(spark, sf):
    """Beta * mean(p(1 - p))."""
    with S.kept(doc_features(spark, sf)) as d:
        model, _ = S.fit_logit(d, "quality", LOGIT)
        return S.ame_shortcut(model, d, LOGIT)


@query("logit_stats")
def logit_stats(spark, sf):
    """Model statistics."""
    model, _ = S.fit_logit(doc_features(spark, sf), "quality", LOGIT)
    return S.logit_stats(model, spark)


@query("logit_stepwise")
def logit_stepwise(spark, sf):
    """J15 + J16: cumulative groups (size, structure, language, squared terms)."""
    from ordertide.operators.prep import squared
    d = squared(doc_features(spark, sf), ["n_words"])
    groups = [["n_words", "n_lines"], ["n_digits", "n_upper", "n_punct"], ["is_en"], ["n_words_sq"]]
    return S.stepwise_logits(d, "quality", groups)


# --------------------------------------------------------------------------
# Feature scores and consensus
# --------------------------------------------------------------------------

@query("variance_filter", oracle="WITH " + _SQL_ALL_FEATURES + "\nUNION ALL ".join(
    f"SELECT '{c}' AS feature, round(var_pop({c}), 6) AS variance, var_pop({c}) > 0.01 AS selected FROM f"
    for c in FEATURES))
def variance_filter(spark, sf):
    v = S.variance_filter(doc_features(spark, sf, labelled=False), FEATURES, 0.01)
    return v.withColumn("variance", F.round("variance", 6))


def _sql_anova(c):
    return (f"SELECT '{c}' AS feature, round(((sum(ns * m * m) - sum(s) * sum(s) / sum(ns)) / (count(*) - 1)) / "
            f"((sum(ss) - sum(ns * m * m)) / (sum(ns) - count(*))), 6) AS f_score FROM "
            f"(SELECT quality, count(*) AS ns, sum({c}) AS s, sum({c} * {c}) AS ss, avg({c}) AS m FROM f "
            f"GROUP BY quality)")


@query("anova_f", oracle="WITH " + _SQL_FEATURES + "\nUNION ALL ".join(_sql_anova(c) for c in FEATURES))
def anova_f(spark, sf):
    a = S.anova_f(doc_features(spark, sf), "quality", FEATURES)
    return a.withColumn("f_score", F.round("f_score", 6))


@query("binned_mi", oracle="WITH " + _SQL_FEATURES + """,
x AS (""" + " UNION ALL ".join(f"SELECT doc_id, quality AS y, '{c}' AS feature, {c} AS v FROM f" for c in FEATURES) + """),
cut AS (SELECT DISTINCT feature, unnest(quantile_cont(v, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9])) AS edge FROM x GROUP BY feature),
b AS (SELECT x.feature, x.doc_id, x.y, count(cut.edge) AS bin FROM x LEFT JOIN cut ON cut.feature = x.feature AND x.v > cut.edge
      GROUP BY x.feature, x.doc_id, x.y),
cell AS (SELECT feature, bin, y, CAST(count(*) AS DOUBLE) AS k FROM b GROUP BY feature, bin, y),
part AS (SELECT *, sum(k) OVER (PARTITION BY feature) AS t, sum(k) OVER (PARTITION BY feature, bin) AS kb, sum(k) OVER (PARTITION BY feature, y) AS ky FROM cell)
SELECT feature, round(sum(k / t * ln(k * t / (kb * ky))), 6) AS mutual_info FROM part GROUP BY feature
""")
def binned_mi(spark, sf):
    """Mutual information (nats) of decile bins and the label."""
    out = S.binned_mutual_info(doc_features(spark, sf), "quality", FEATURES)
    return out.withColumn("mutual_info", F.round("mutual_info", 6))


@query("consensus_rank")
def consensus_rank(spark, sf):
    """K16 (J18-J24): six scores joined by feature name, max-scaled, averaged, ranked."""
    from ordertide.plans.studies import feature_selection_consensus
    return feature_selection_consensus(doc_features(spark, sf), "quality", FEATURES + ["is_en"])


@query("regression_study")
def regression_study(spark, sf):
    """K14 (+ C25j): stepwise and final logit; odds ratios joined to marginal effects by term."""
    from ordertide.operators.prep import squared
    from ordertide.plans.studies import regression_study as study
    d = squared(doc_features(spark, sf), ["n_words"])
    out = study(d, "quality", [["n_words", "n_lines"], ["n_digits", "n_upper", "n_punct"], ["is_en"]],
                ["n_words", "n_words_sq", "n_punct", "is_en"])
    return out["or_me"]


@query("multicollinearity_reduction")
def multicollinearity_reduction(spark, sf):
    """K15 (J5 + J6): VIF split at 10, PCA on the collinear rest (train fit), VIF before / after."""
    from ordertide.operators.prep import time_split
    from ordertide.plans.studies import multicollinearity_reduction as reduce_
    with S.kept(doc_features(spark, sf, labelled=False).withColumn("__t", F.timestamp_seconds("doc_id"))) as d:
        d = time_split(d, "__t", ["doc_id"], 0.8)
        _, _, comparison, _ = reduce_(d.filter(F.col("split") == "train"), d.filter(F.col("split") == "test"),
                                      ["doc_id", "quality"], FEATURES, threshold=10.0)
        return comparison


@query("classifier_study")
def classifier_study(spark, sf):
    """Impute, time split, hybrid encoding, scaling, tuned forest, test metrics."""
    from ordertide.plans.studies import classifier_study as study
    d = doc_features(spark, sf).join(table(spark, sf, "documents").select("doc_id", "lang"), "doc_id")
    d = d.withColumn("__t", F.timestamp_seconds("doc_id"))
    return study(d, "quality", FEATURES, "lang", "__t", ["doc_id"], min_count=110)


# --------------------------------------------------------------------------
# Models (rows only)
# --------------------------------------------------------------------------

@query("rf_balanced")
def rf_balanced(spark, sf):
    """J26 + J36: class-weighted forest, importance table."""
    d = doc_features(spark, sf)
    m = M.rf_balanced(d, "quality", FEATURES + ["is_en"])
    return M.feature_importance(m, FEATURES + ["is_en"], spark)


@query("gbt_weighted")
def gbt_weighted(spark, sf):
    """J28 + J29 + J39 + J33: weighted GBT that stops after 10 rounds without gain, scored, report."""
    from ordertide.operators.prep import time_split
    cols = FEATURES + ["is_en"]
    with S.kept(doc_features(spark, sf).withColumn("__t", F.timestamp_seconds("doc_id"))) as d:
        d = time_split(d, "__t", ["doc_id"], 0.8).withColumn("is_valid", F.col("split") == "test")
        m = M.gbt_weighted(d, "quality", cols, valid_col="is_valid")
        return M.classification_report(M.score_batch(m, d, cols), "quality", "prediction")


@query("cv_search")
def cv_search(spark, sf):
    """J30 + J31: 3-fold CV over a seeded random grid, class weights, precision in the top 20 %."""
    d = doc_features(spark, sf)
    est, space, scorer = M.model_factory("random_forest", label="quality")
    cv = M.cv_search(d, "quality", FEATURES + ["is_en"], est, space, scorer)
    best = cv.bestModel
    return spark.createDataFrame([(int(best.getNumTrees), int(best.getMaxDepth()), float(max(cv.avgMetrics)))],
                                 "num_trees int, max_depth int, best_precision_at_20pct double")


@query("balanced_forest")
def balanced_forest(spark, sf):
    """A forest of class-balanced draws per tree, scored and reported."""
    cols = FEATURES + ["is_en"]
    with S.kept(doc_features(spark, sf)) as d:
        m = M.balanced_forest(d, "toxic", cols, ["doc_id"])
        return M.classification_report(M.score_batch(m, d, cols), "toxic", "prediction")


@query("pca_model")
def pca_model(spark, sf):
    """PCA(4) -> GBT pipeline on embeddings, evaluated like the others."""
    e, cols = _embedding_cols(spark, sf)
    e = e.withColumn("label", (F.col("label") > 0).cast("int"))
    model = M.pca_pipeline(cols, 4, "label").fit(e)
    return M.classification_report(model.transform(e), "label", "prediction")


# --------------------------------------------------------------------------
# Ranking metrics against a deterministic score
# --------------------------------------------------------------------------

def scored_docs(spark, sf):
    d = doc_features(spark, sf)
    marks, chars = F.col("n_upper") + F.col("n_digits"), F.col("n_chars")
    # a document without characters: as in the SQL, 0 / 0 is NaN (the largest score) and no error
    empty = F.when(marks > 0, F.lit(float("inf"))).when(marks == 0, F.lit(float("nan")))
    return d.select("doc_id", F.col("quality").alias("label"), F.when(chars == 0, empty).otherwise(F.try_divide(marks, chars)).alias("score"))


_SQL_SCORED = "WITH " + _SQL_FEATURES + """,
sd AS (SELECT doc_id, quality AS label, (n_upper + n_digits) / n_chars AS score FROM f)
"""


@query("precision_recall_at_k", oracle=_SQL_SCORED + """,
r AS (SELECT *, row_number() OVER (ORDER BY score DESC, doc_id ASC, label ASC) AS rk,
             sum(label) OVER (ORDER BY score DESC, doc_id ASC, label ASC ROWS UNBOUNDED PRECEDING) AS tp,
             count(*) OVER () AS n, sum(label) OVER () AS pos FROM sd),
k AS (SELECT p, greatest(1, CAST(floor((SELECT count(*) FROM sd) * p) AS INTEGER)) AS k
      FROM (SELECT unnest([0.05, 0.1, 0.2]) AS p))
SELECT CAST(k.p AS DOUBLE) AS pct, k.k, CAST(r.tp AS INTEGER) AS true_positives, r.tp / k.k AS precision_at_k,
       r.tp / r.pos AS recall_at_k
FROM k JOIN r ON r.rk = k.k
""")
def precision_recall_at_k(spark, sf):
    return M.precision_recall_at_k(scored_docs(spark, sf), "label", "score", [0.05, 0.1, 0.2])


@query("confusion", oracle=_SQL_SCORED + """
SELECT label, CAST(score >= 0.05 AS INTEGER) AS prediction, count(*) AS n FROM sd GROUP BY ALL
""")
def confusion(spark, sf):
    s = scored_docs(spark, sf).withColumn("prediction", (F.col("score") >= 0.05).cast("int"))
    return M.confusion(s, "label", "prediction")


_SQL_CURVE = _SQL_SCORED + """,
per AS (SELECT score AS threshold, sum(label) AS pos_t, count(*) AS cnt FROM sd GROUP BY score),
cur AS (SELECT threshold, pos_t,
               sum(pos_t) OVER (ORDER BY threshold DESC ROWS UNBOUNDED PRECEDING) AS tp,
               sum(cnt) OVER (ORDER BY threshold DESC ROWS UNBOUNDED PRECEDING) AS predicted_pos,
               (SELECT sum(label) FROM sd) AS p_all FROM per)
"""


@query("pr_curve", oracle=_SQL_CURVE + """
SELECT threshold, CAST(pos_t AS BIGINT) AS positives_at_threshold, CAST(tp AS BIGINT) AS tp,
       CAST(predicted_pos AS BIGINT) AS predicted_pos, tp / predicted_pos AS precision, tp / p_all AS recall
FROM cur
""")
def pr_curve(spark, sf):
    return M.pr_curve(scored_docs(spark, sf), "label", "score")


@query("average_precision", oracle=_SQL_CURVE + """
SELECT round(sum(pos_t * (tp / predicted_pos)) / sum(pos_t), 9) AS average_precision FROM cur
""")
def average_precision(spark, sf):
    ap = M.average_precision(M.pr_curve(scored_docs(spark, sf), "label", "score"))
    return ap.withColumn("average_precision", F.round("average_precision", 9))


@query("best_f1_threshold", oracle=_SQL_CURVE + """,
c2 AS (SELECT threshold, 2 * (tp / predicted_pos) * (tp / p_all) / ((tp / predicted_pos) + (tp / p_all) + 1e-9) AS f1
       FROM cur)
SELECT arg_max(threshold, (f1, threshold)) AS threshold, round(max(f1), 9) AS f1 FROM c2
""")
def best_f1_threshold(spark, sf):
    b = M.best_f1_threshold(M.pr_curve(scored_docs(spark, sf), "label", "score"))
    return b.withColumn("f1", F.round("f1", 9))


@query("score_histogram", oracle=_SQL_SCORED + """
SELECT CAST(least(floor(score * 10), 9) AS INTEGER) AS bin, label, count(*) AS n FROM sd GROUP BY ALL
""")
def score_histogram(spark, sf):
    return M.score_histogram(scored_docs(spark, sf), "label", "score", 10)
