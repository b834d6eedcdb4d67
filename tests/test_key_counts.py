"""KPI distinct counts by brute force, and one scan of the lines."""

import random
from decimal import Decimal

from pyspark.sql import functions as F

from ordertide import catalog
from ordertide.plans.kpis import nested_key_counts

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_key_counts(spark):
    """Null parts of keys, lines of several deliveries, orders that repeat, in one or two groups, or have no lines."""
    rng = random.Random(1)
    rows = [(rng.choice([None, *range(12)]), rng.choice([None, 1, 2, 3]), rng.choice([None, 1, 2]), rng.choice([None, True, False]), Decimal(rng.randrange(999)) / 100)
            for _ in range(300)]
    orders = [(k, "x") for k in range(10)] + [(3, "x"), (4, "y"), (5, None), (77, "x"), (None, "x")]
    lines = spark.createDataFrame(rows, "o long, d long, l int, hit boolean, v decimal(18,2)")
    got = nested_key_counts(lines, spark.createDataFrame(orders, "o long, g string"), "o", "g", "d", "l", F.col("hit"), F.col("v")).first()
    joined = [(g, *r) for r in rows for k, g in orders if k is not None and k == r[0]]
    hit = [r for r in joined if r[4]]
    assert got.asDict() == {"n_orders": len({r[:2] for r in joined}), "n_deliveries": len({r[:3] for r in joined}), "n_affected_deliveries": len({r[:3] for r in hit}),
                            "affected_value": float(sum(r[5] for r in hit)), "n_affected_lines": len({(*r[:2], r[3]) for r in hit})}
    none = nested_key_counts(lines.limit(0), spark.createDataFrame(orders, "o long, g string"), "o", "g", "d", "l", F.col("hit"), F.col("v")).first()
    assert tuple(none) == (0, 0, 0, None, 0)


def test_key_counts_read_the_lines_once(spark):
    catalog.load_all()
    assert plan(catalog.REGISTRY["kpi_distinct_counts"](spark, SF)).count("lineitem.parquet") == 1
