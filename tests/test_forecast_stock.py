"""Stock days only let forecasts through."""

import datetime as dt

from ordertide.plans.forecast import forecast_days


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_stock_days_only_let_forecasts_through(spark):
    """Stock rows may repeat: they aren't grouped, and forecasts are not repeated by them."""
    day = dt.date(1997, 1, 5)
    stock = spark.createDataFrame([(1, 7, day)] * 3 + [(1, 7, day + dt.timedelta(2)), (None, 7, day)], "l_suppkey long, l_partkey long, local_date date")
    forecast = spark.createDataFrame([(1, 7, day, 2.5), (1, 7, day + dt.timedelta(1), 3.5), (1, 7, day + dt.timedelta(2), 4.5), (None, 7, day, 1.0)],
                                     "l_suppkey long, l_partkey long, local_forecast_date date, operational_forecast double")
    items = spark.createDataFrame([(7, "ART")], "l_partkey long, item_type string")
    units = spark.createDataFrame([(1, "CDC", 1)], "l_suppkey long, business_unit_type string, business_unit_code long")
    volumes = spark.createDataFrame([(7, dt.date(1990, 1, 1), dt.date(1997, 1, 5), 0.5)], "l_partkey long, valid_from date, valid_to date, net double")
    out = forecast_days(stock, forecast, items, units, volumes, "1996-01-01", "1999-12-31")
    assert sorted(tuple(r)[2:] for r in out.collect()) == [(day, 2.5, 0.5, None, None, 4.5, None), (day + dt.timedelta(2), 4.5, None, 2.5, 0.5, None, None)]
    assert "LeftSemi" in plan(out)
