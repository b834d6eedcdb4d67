"""Disjoint intervals are matched by a window, not exploded for a join."""

import datetime as dt
import random

import pytest

from ordertide import catalog
from ordertide.operators import relational as R

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("closed, width", [("both", 1), ("both", 30), ("left", 7), ("left", 400)])
def test_disjoint_intervals_by_a_window(spark, closed, width):
    """Gaps, empty and open-ended intervals, null keys and times, a hot key: as the plain range join."""
    rng, day = random.Random(width), lambda n: None if n is None else dt.date(2020, 1, 1) + dt.timedelta(n)
    intervals = [(None, day(0), day(900), -1), ("a", None, day(9), -2), ("a", day(900), None, -3)]
    for k, n in (("a", 120), ("b", 4), ("c", 1)):
        cuts = sorted(rng.choices(range(800), k=n)) + [None]
        for i, (s, e) in enumerate(zip(cuts, cuts[1:])):
            last = dt.date(2099, 12, 31) if e is None else day(e - (closed == "both") - rng.choice([0, 0, 3]))
            intervals.append((k, day(s), last, len(intervals)))
    rows = [(rng.choice(["a", "a", "a", "b", "c", "x", None]), rng.choice([None, *map(day, range(-50, 1000))]), i) for i in range(400)] + [("a", day(899), 9_999)]
    left = spark.createDataFrame(rows, "k string, t date, id int")
    right = spark.createDataFrame(intervals, "k string, s date, e date, iid int")
    want = R.interval_join(left, right, ["k"], "t", "s", "e", closed=closed)
    got = R.interval_join(left, right, ["k"], "t", "s", "e", closed=closed, bucket_days=width, disjoint=True, within=(left, "t"))
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) != []


def test_validity_intervals_are_not_joined_by_bucket(spark):
    catalog.load_all()
    assert "__rbk" not in plan(catalog.REGISTRY["validity_interval_join"](spark, SF))
