"""Every catalogue query against its DuckDB oracle on sf0.001 (the driver
runs the same comparison on sf0.01); queries without an oracle must run."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from oracle_check import rows_key  # noqa: E402

from conftest import SF_MID, SF_SMALL  # noqa: E402

QUERIES = E.queries()
ORACLES = E.oracle_sql()
# fitted level lists (hence output columns) depend on the data size
AT_SF001 = {"hybrid_encode"}
SLOW = {"cv_search", "classifier_study", "balanced_forest"}      # hundreds of trees; their parts: test_models.py


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n in ORACLES))
def test_query_matches_oracle(spark, duck, duck_sf001, name):
    sf, con = (SF_MID, duck_sf001) if name in AT_SF001 else (SF_SMALL, duck)
    sdf = QUERIES[name](spark, sf)
    srows = [tuple(r) for r in sdf.collect()]
    res = con.execute(ORACLES[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(sdf.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert rows_key(sdf.columns, srows) == rows_key(dcols, drows)


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n not in ORACLES and n not in SLOW))
def test_query_without_oracle_runs(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    assert df.count() >= 0
    assert len(df.columns) > 0


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "avg_euros" in df.columns
