
import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ordertide.functions import scalars as S
from ordertide.functions.predicates import reason_code_filter
from ordertide.operators import ml as M
from ordertide.operators import prep as X
from ordertide.operators import relational as R
from ordertide.operators import stats as ST
from ordertide.operators import sweep
from ordertide.operators import windows as W

T0 = dt.datetime(2024, 1, 1)


def ts(h, m=0, s=0, us=0, day=0):
    return T0 + dt.timedelta(days=day, hours=h, minutes=m, seconds=s, microseconds=us)


# --------------------------------------------------------------------------
# dedup
# --------------------------------------------------------------------------

def test_latest_per_key_nulls_last_and_ties(spark):
    df = spark.createDataFrame(
        [(1, None, "a"), (1, ts(1), "b"), (1, ts(1), "c"), (2, None, "d")], "k int, t timestamp_ntz, v string")
    out = R.latest_per_key(df, ["k"], [F.desc_nulls_last("t")], [F.desc("v")])
    got = {r.k: r.v for r in out.collect()}
    assert got == {1: "c", 2: "d"}


def test_any_per_key_is_deterministic(spark):
    df = spark.createDataFrame([(1, 5), (1, 3), (2, 9)], "k int, v int")
    assert {r.k: r.v for r in R.any_per_key(df, ["k"]).collect()} == {1: 3, 2: 9}


# --------------------------------------------------------------------------
# as-of, interval, last-event and look-back rewrites vs their naive forms
# --------------------------------------------------------------------------

def _random_sides(spark, seed=7, n_left=300, n_right=300):
    rnd = random.Random(seed)
    right = sorted({(rnd.choice([1, 2, 3]), rnd.randrange(0, 10 * 86400)) for _ in range(n_right)})
    left = [(i, rnd.choice([1, 2, 3, None]), rnd.randrange(0, 10 * 86400)) for i in range(n_left)]
    left += [(10_000 + i, k, s) for i, (k, s) in enumerate(right[:20])]          # equal timestamps
    r = spark.createDataFrame([(k, T0 + dt.timedelta(seconds=s), float(s % 97)) for k, s in right],
                              "k int, rts timestamp_ntz, v double")
    l = spark.createDataFrame([(i, k, T0 + dt.timedelta(seconds=s)) for i, k, s in left],
                              "id int, k int, lts timestamp_ntz")
    return l, r


def _naive_asof(l, r):
    j = l.join(r, (l.k == r.k) & (r.rts <= l.lts), "left")
    w = Window.partitionBy("id").orderBy(F.desc_nulls_last("rts"))
    return (j.withColumn("rn", F.row_number().over(w)).filter("rn = 1")
            .select("id", "rts", "v"))


@pytest.mark.parametrize("bucket", [None, "1 day"])
def test_asof_matches_range_join(spark, bucket):
    l, r = _random_sides(spark)
    got = R.asof_join(l, r, ["k"], "lts", "rts", ["rts", "v"], bucket=bucket).select("id", "rts", "v")
    assert sorted(got.collect()) == sorted(_naive_asof(l, r).collect())


@pytest.mark.parametrize("closed", ["left", "both"])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_interval_join_bucketed_equals_plain(spark, closed, how):
    rnd = random.Random(3)
    iv = [(rnd.choice([1, 2]), ts(0, day=a), ts(0, day=a + rnd.randrange(0, 5)), i)
          for i, a in enumerate(rnd.sample(range(40), 25))]
    ev = [(i, rnd.choice([1, 2, None]), ts(rnd.randrange(24), day=rnd.randrange(45))) for i in range(200)]
    ivs = spark.createDataFrame(iv, "k int, s timestamp_ntz, e timestamp_ntz, iid int")
    evs = spark.createDataFrame(ev, "eid int, k int, t timestamp_ntz")
    a = R.interval_join(evs, ivs, ["k"], "t", "s", "e", closed=closed, how=how).select("eid", "iid")
    b = R.interval_join(evs, ivs, ["k"], "t", "s", "e", closed=closed, how=how, bucket_days=2).select("eid", "iid")
    assert sorted(a.collect(), key=str) == sorted(b.collect(), key=str)


def test_last_event_time_equals_interval_join(spark):
    rows = [(1, ts(h), q) for h, q in enumerate([5, 0, 0, 3, 0, 2, 0])]
    df = spark.createDataFrame(rows, "k int, t timestamp_ntz, q int")
    w = Window.partitionBy("k").orderBy("t")
    f = df.withColumn("so", ((F.col("q") == 0) & (F.lag("q").over(w) > 0)).cast("int"))
    got = R.last_event_time(f, ["k"], "t", F.col("so") == 1, "last").select("t", "last")
    ev = R.close_intervals(f.filter("so = 1").select("k", F.col("t").alias("s")), ["k"], "s", "e",
                           F.lit("2100-01-01").cast("timestamp_ntz"))
    naive = R.interval_join(f, ev, ["k"], "t", "s", "e", how="left").select("t", F.col("s").alias("last"))
    assert sorted(got.collect()) == sorted(naive.collect())


def test_lookback_counts_equals_theta_join_with_month_end(spark):
    days = [dt.date(2024, 3, d) for d in (1, 29, 30, 31)] + [dt.date(2024, 1, 31), dt.date(2024, 2, 29)]
    spine = spark.createDataFrame([(1, d) for d in days], "k int, d date")
    ev = spark.createDataFrame([(i, 1, dt.date(2024, 1, 1) + dt.timedelta(days=i)) for i in range(0, 90, 2)],
                               "eid int, k int, e date")
    got = R.lookback_counts(spine, ev, ["k"], "d", "e", {"n": F.count_distinct("eid")}).fillna(0, ["n"])
    s, e = spine.alias("s"), ev.alias("e")
    naive = (s.join(e, (F.col("s.k") == F.col("e.k")) & (F.col("e.e") >= F.add_months(F.col("s.d"), -1))
                    & (F.col("e.e") <= F.date_sub(F.col("s.d"), 1)), "left")
             .groupBy("s.k", "s.d").agg(F.count_distinct("e.eid").alias("n")))
    assert sorted(got.select("d", "n").collect()) == sorted(naive.select("d", "n").collect())


def test_distinct_count_over_with_nulls(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (1, None), (2, None)], "k int, v int")
    got = {(r.k, r.n) for r in W.distinct_count_over(df, ["k"], "v", "n").collect()}
    assert got == {(1, 2), (2, 0)}


def test_rank_by_buckets_equals_row_number(spark):
    rnd = random.Random(1)
    df = spark.createDataFrame([(i, rnd.randrange(50)) for i in range(500)], "id int, v int")
    got = X.rank_by_buckets(df, F.floor(F.col("v") / 7), ["v", "id"]).select("id", "__rank")
    exp = df.withColumn("r", F.row_number().over(Window.orderBy("v", "id"))).select("id", "r")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, exp.collect()))


def test_time_split_and_ratio_sample(spark):
    rows = [(i, T0 + dt.timedelta(minutes=(i * 37) % 500), i % 4 == 0, "a" if i % 3 else "b") for i in range(400)]
    df = spark.createDataFrame(rows, "id int, t timestamp_ntz, pos boolean, s string")
    sp = X.time_split(df, "t", ["id"], 0.8)
    assert sp.filter("split = 'train'").count() == 320
    last_train = sp.filter("split = 'train'").agg(F.max(F.struct("t", "id"))).first()[0]
    first_test = sp.filter("split = 'test'").agg(F.min(F.struct("t", "id"))).first()[0]
    assert tuple(last_train) < tuple(first_test)
    lab = df.withColumn("label", F.col("pos").cast("int"))
    smp = X.ratio_sample(lab, "label", ["id"], 1.0, ["s"])
    for r in smp.groupBy("s").agg(F.sum("label").alias("p"), F.count(F.lit(1)).alias("n")).collect():
        assert r.n == 2 * r.p


# --------------------------------------------------------------------------
# scalar traps
# --------------------------------------------------------------------------

def test_scalar_traps(spark):
    df = spark.createDataFrame([("1→2 on 2024-08-01", ts(0, 0, 0, 900_000), ts(0, 0, 1, 100_000), 2.5, "07:30-16:00")],
                               "c string, a timestamp_ntz, b timestamp_ntz, x double, sh string")
    r = df.select(S.regexp_group("c", r"(\d+)→").alias("g"), S.regexp_group("c", r"(x+)").alias("miss"),
                  S.seconds_between("a", "b").alias("sec"), S.round_half_away("x").alias("r1"),
                  S.round_half_away(-F.col("x")).alias("r2"), S.normalise_shift("sh").alias("n"),
                  S.normalise_shift(F.lit(None).cast("string")).alias("closed"),
                  S.parse_time_secs(F.lit("25:99:00")).alias("bad"),
                  S.safe_ratio(F.lit(1), F.lit(0)).alias("div0")).first()
    assert r.g == "1" and r.miss is None
    assert r.sec == 0                      # 0.2 s apart: whole seconds truncate
    assert (r.r1, r.r2) == (3.0, -3.0)     # half away from zero
    assert r.n == "07:30:00-16:00:00" and r.closed == "00:00:00-00:00:00"
    assert r.bad is None and r.div0 is None


def test_timezone_autumn_hour(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 10, 27, 2, 30),)], "t timestamp")
    r = df.select(S.to_utc("t", "Europe/Paris").alias("u")).first().u
    assert r is not None


def test_reason_filter_precedence(spark):
    df = spark.createDataFrame([("Deviation", "X", False), ("Auto-recovery", "Y", True), ("Deviation", "X", True)],
                               "kind string, reason string, in_dates boolean")
    f = reason_code_filter(F.col("reason") == "X", F.col("in_dates"), F.lit(True),
                           F.col("kind") == "Deviation", F.col("kind") == "Auto-recovery", F.lit(True))
    assert sorted(r.kind for r in df.filter(f).collect()) == ["Auto-recovery", "Deviation"]


def test_unnest_outer_keeps_empty(spark):
    df = spark.createDataFrame([(1, [1, 2]), (2, []), (3, None)], "id int, a array<int>")
    assert df.select("id", F.explode_outer("a")).count() == 4
    assert df.select("id", F.explode("a")).count() == 2


# --------------------------------------------------------------------------
# statistics vs NumPy
# --------------------------------------------------------------------------

def _design(spark, n=400, seed=0):
    rng = np.random.default_rng(seed)
    x1 = rng.normal(size=n)
    x2 = 0.8 * x1 + rng.normal(scale=0.5, size=n)
    x3 = rng.normal(size=n) + 2
    eta = -0.3 + 0.9 * x1 - 0.6 * x3
    y = (rng.random(n) < 1 / (1 + np.exp(-eta))).astype(int)
    pdf = [(float(a), float(b), float(c), int(d)) for a, b, c, d in zip(x1, x2, x3, y)]
    return spark.createDataFrame(pdf, "x1 double, x2 double, x3 double, y int"), np.c_[x1, x2, x3], y


def _vif_numpy(X, intercept):
    out = []
    for j in range(X.shape[1]):
        others = np.delete(X, j, axis=1)
        A = np.c_[np.ones(len(X)), others] if intercept else others
        beta, *_ = np.linalg.lstsq(A, X[:, j], rcond=None)
        rss = np.sum((X[:, j] - A @ beta) ** 2)
        tss = np.sum((X[:, j] - X[:, j].mean()) ** 2) if intercept else np.sum(X[:, j] ** 2)
        out.append(tss / rss)
    return np.array(out)


@pytest.mark.parametrize("intercept", [True, False])
def test_vif_matches_least_squares(spark, intercept):
    df, X, _ = _design(spark)
    got = {r.feature: r.vif for r in ST.vif(df, ["x1", "x2", "x3"], intercept).collect()}
    exp = _vif_numpy(X, intercept)
    assert np.allclose([got["x1"], got["x2"], got["x3"]], exp, rtol=1e-6)


def test_logit_matches_numpy_irls(spark):
    df, X, y = _design(spark)
    model, _ = ST.fit_logit(df, "y", ["x1", "x2", "x3"])
    A = np.c_[X, np.ones(len(X))]
    b = np.zeros(A.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-A @ b))
        W_ = p * (1 - p)
        b = b + np.linalg.solve(A.T @ (A * W_[:, None]), A.T @ (y - p))
    got = np.r_[model.coefficients.toArray(), model.intercept]
    assert np.allclose(got, b, atol=1e-5)
    se = np.sqrt(np.diag(np.linalg.inv(A.T @ (A * W_[:, None]))))
    assert np.allclose(model.summary.coefficientStandardErrors, se, rtol=1e-4)
    st = ST.logit_stats(model, spark).first()
    ll = np.sum(y * np.log(p) + (1 - y) * np.log(1 - p))
    assert math.isclose(st.log_likelihood, ll, rel_tol=1e-6)
    me = {r.term: r.ame for r in ST.marginal_effects(model, df, ["x1", "x2", "x3"]).collect()}
    assert math.isclose(me["x1"], b[0] * np.mean(p * (1 - p)), rel_tol=1e-6)


def test_pca_matches_numpy_up_to_sign(spark):
    df, X, _ = _design(spark)
    m = ST.fit_pca(df, ["x1", "x2", "x3"])
    ev = m.stages[-1].explainedVariance.toArray()
    C = np.cov(X, rowvar=False)
    w = np.sort(np.linalg.eigvalsh(C))[::-1]
    assert np.allclose(ev, w / w.sum(), atol=1e-8)
    sc = ST.pca_scores(m, df, ["x1"]).select("multicollinearity_PC1").toPandas().values[:, 0]
    Xc = X - X.mean(axis=0)
    v = np.linalg.eigh(C)[1][:, -1]
    assert np.allclose(np.abs(sc), np.abs(Xc @ v), atol=1e-8)


def test_chi2_sf():
    assert math.isclose(ST.chi2_sf(3.841458820694124, 1), 0.05, rel_tol=1e-6)
    assert math.isclose(ST.chi2_sf(18.307038053275146, 10), 0.05, rel_tol=1e-6)


def test_pr_curve_and_average_precision(spark):
    rows = [(1, 0.9), (0, 0.8), (1, 0.8), (0, 0.3), (1, 0.2)]
    df = spark.createDataFrame(rows, "label int, score double")
    cur = {r.threshold: (r.tp, r.predicted_pos) for r in M.pr_curve(df, "label", "score").collect()}
    assert cur == {0.9: (1, 1), 0.8: (2, 3), 0.3: (2, 4), 0.2: (3, 5)}
    ap = M.average_precision(M.pr_curve(df, "label", "score")).first()[0]
    assert math.isclose(ap, (1 / 3) * 1 + (1 / 3) * (2 / 3) + (1 / 3) * (3 / 5))
    pk = M.precision_recall_at_k(df, "label", "score", [0.4]).first()
    assert pk.k == 2 and pk.true_positives == 1


def test_hybrid_encoder_unseen_level(spark):
    train = spark.createDataFrame([("a",)] * 5 + [("b",)] * 5 + [("c",)], "cat string")
    test = spark.createDataFrame([("a",), ("z",), (None,)], "cat string")
    m = X.HybridEncoder(inputCol="cat", minCount=2, dropFirst=True).fit(train)
    out = {r.cat: r for r in m.transform(test).collect()}
    assert out["OTHER"]["cat_count"] == 1            # unseen 'z' grouped with the rare level
    assert out["a"]["cat_a"] == 1 and out["OTHER"]["cat_a"] == 0


def test_parts_sum_invariant(spark):
    from ordertide.operators.profile import assert_parts_sum
    ok = spark.createDataFrame([(1, 2, 3)], "a int, b int, t int")
    assert_parts_sum(ok, ["a", "b"], "t")
    with pytest.raises(AssertionError):
        assert_parts_sum(spark.createDataFrame([(1, 2, 4)], "a int, b int, t int"), ["a", "b"], "t")


def test_estimated_days_to_stockout_branches(spark):
    from ordertide.plans.availability import estimated_days_to_stockout as est
    rows = [(0.0, 1.0, -1.0, 1.0), (10.0, -2.0, 0.0, 1.0), (10.0, -2.0, -3.0, 1.0), (10.0, 1.0, None, 4.0),
            (10.0, 0.0, None, 0.0)]
    df = spark.createDataFrame(rows, "q double, cur double, nonpos double, allr double")
    got = [r[0] for r in df.select(est(F.col("q"), F.col("cur"), F.col("nonpos"), F.col("allr"))).collect()]
    assert got == [0.0, 5.0, 3.0, 2.0, None]


@pytest.mark.parametrize("bucket", [None, 7.0, "3 days"])
def test_asof_numeric_and_date_keys(spark, bucket):
    rnd = random.Random(9)
    right = sorted({(rnd.choice([1, 2]), rnd.randrange(0, 200)) for _ in range(120)})
    left = [(i, rnd.choice([1, 2]), rnd.randrange(-5, 210) + rnd.random()) for i in range(150)]
    if isinstance(bucket, str):     # date keys
        r = spark.createDataFrame([(k, dt.date(2024, 1, 1) + dt.timedelta(days=v), float(v)) for k, v in right],
                                  "k int, rk date, v double")
        l = spark.createDataFrame([(i, k, dt.date(2024, 1, 1) + dt.timedelta(days=int(x))) for i, k, x in left],
                                  "id int, k int, lk date")
    else:
        r = spark.createDataFrame([(k, float(v), float(v)) for k, v in right], "k int, rk double, v double")
        l = spark.createDataFrame(left, "id int, k int, lk double")
    got = R.asof_join(l, r, ["k"], "lk", "rk", ["v"], bucket=bucket).select("id", "v")
    j = l.join(r, (l.k == r.k) & (r.rk <= l.lk), "left")
    w = Window.partitionBy("id").orderBy(F.desc_nulls_last("rk"))
    exp = j.withColumn("rn", F.row_number().over(w)).filter("rn = 1").select("id", "v")
    assert sorted(got.collect()) == sorted(exp.collect())


def test_lookback_sums_equal_lookback_counts(spark):
    rnd = random.Random(4)
    ev = spark.createDataFrame([(i, rnd.choice([1, 2]), dt.date(2024, 1, 1) + dt.timedelta(days=rnd.randrange(70)),
                                 rnd.random() < 0.3) for i in range(400)], "eid int, k int, e date, dev boolean")
    spine = spark.createDataFrame([(k, dt.date(2024, 1, 1) + dt.timedelta(days=d)) for k in (1, 2) for d in range(75)],
                                  "k int, d date")
    direct = R.lookback_counts(spine, ev, ["k"], "d", "e", {
        "n": F.count_distinct("eid"), "n_dev": F.count_distinct(F.when(F.col("dev"), F.col("eid")))})
    daily = ev.groupBy("k", "e").agg(F.count_distinct("eid").alias("n"),
                                    F.count_distinct(F.when(F.col("dev"), F.col("eid"))).alias("n_dev"))
    summed = sweep.lookback_sums(spine, daily, ["k"], "d", "e", ["n", "n_dev"])
    a = sorted(direct.fillna(0, ["n", "n_dev"]).collect())
    b = sorted(summed.fillna(0, ["n", "n_dev"]).collect())
    assert a == b


@pytest.mark.parametrize("months", [1, 2])
def test_sweep_counts_recurring_keys_once(spark, months):
    """Keys that recur within the look-back, month ends of a leap year and of a common one, against the theta form."""
    rnd = random.Random(11)
    first = dt.date(2023, 12, 20)
    ev = spark.createDataFrame([(rnd.choice([1, 2]), rnd.randrange(12), first + dt.timedelta(days=rnd.randrange(500)), rnd.random() < 0.4)
                                for _ in range(900)] + [(1, 3, None, True)], "k int, key int, e date, stock boolean")
    spine = spark.createDataFrame([(k, first + dt.timedelta(days=d)) for k in (1, 2, 3) for d in range(560)], "k int, d date")
    got = sweep.lookback_distinct(spine, ev, ["k"], "d", "e", ["key"], "n", {"n_stock": F.col("stock")}, months)
    want = R.lookback_counts(spine, ev, ["k"], "d", "e", {"n": F.count_distinct("key"), "n_stock": F.count_if("stock")}, months)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.select("k", "d", "n", "n_stock").collect()))


def test_sweep_of_a_hot_node_has_a_row_a_day(spark):
    """A third of all events on one node: the window of the node has at most one row a day."""
    ev = spark.range(6000).select((F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50)).cast("int").alias("k"),
                                  F.expr("date_add(DATE'2024-01-01', cast(id % 90 as int))").alias("e"), (F.col("id") % 700).alias("key"))
    spine = ev.select("k", F.date_add("e", 5).alias("d")).distinct()
    got = sweep.lookback_distinct(spine, ev, ["k"], "d", "e", ["key"], "n")
    want = R.lookback_counts(spine, ev, ["k"], "d", "e", {"n": F.count_distinct("key")})
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_time_split_of_one_time_and_of_edges(spark):
    """A third of all rows share a time, which holds the cut; none and all rows train."""
    rows = [(i, None if i < 5 else T0 if i % 3 == 0 else T0 + dt.timedelta(seconds=i - 300)) for i in range(600)]
    df = spark.createDataFrame(rows, "id int, t timestamp_ntz").repartition(4)
    order = sorted(rows, key=lambda r: (r[1] is not None, r[1] or T0, r[0]))
    for share in (0.0, 0.004, 0.5, 0.8, 1.0):
        got = {r.id for r in X.time_split(df, "t", ["id"], share).filter("split = 'train'").collect()}
        assert got == {r[0] for r in order[:int(share * 600)]}
    assert X.time_split(df, "t", ["id"], 0.8).columns == ["id", "t", "split"]
    assert X.time_split(df.limit(0), "t", ["id"], 0.8).count() == 0


def test_closed_intervals_over_blocks(spark):
    rng = random.Random(7)
    rows = [(None if i % 50 == 0 else rng.choice([1, 1, 2, 3]), T0 + dt.timedelta(hours=rng.randrange(6000), microseconds=i)) for i in range(500)]
    df = spark.createDataFrame(rows, "k int, t timestamp_ntz")
    w = Window.partitionBy("k").orderBy("t")
    want = df.withColumn("e", F.coalesce(F.lead("t").over(w), F.lit("2100-01-01").cast("timestamp_ntz")))
    got = R.close_intervals(df, ["k"], "t", "e", F.lit("2100-01-01").cast("timestamp_ntz"))
    assert got.columns == want.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
