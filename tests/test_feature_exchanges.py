"""final_features: lines are exchanged by part, by order and by node and day, and no more."""

import re

import pytest

from ordertide import catalog


@pytest.fixture()
def no_broadcasts(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_lines_meet_their_order_last(no_broadcasts):
    catalog.load_all()
    plan = catalog.REGISTRY["final_features"](no_broadcasts, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    by = [re.sub(r"#\d+L?", "", x) for x in re.findall(r"Exchange hashpartitioning\(([^)]*), \d+\)", plan)]
    assert not [x for x in by if "l_orderkey," in x or "l_linenumber" in x]      # windows and groups by order and more use the join's
    assert by.count("l_orderkey") == 3 and by.count("l_partkey") == 2            # rows, deviations and (without parts) order counts
    # durations come after the exchange by node and day
    assert plan.index("time_in_status_mins") < plan.index("Exchange hashpartitioning(l_suppkey")
