"""K5 forecast stock and volume per unit, item and day, with the days before and after."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ordertide.operators.relational import interval_join


def forecast_days(stock: DataFrame, plan: DataFrame, items: DataFrame, units: DataFrame, volumes: DataFrame, start: str, end: str,
                  unit: str = "l_suppkey", item: str = "l_partkey") -> DataFrame:
    """Days of ``stock`` that have a forecast in ``plan``, of known items and open units.

    ``volumes`` are item volumes with validity dates (both ends included); a day without a
    valid one keeps its row.  A day of ``stock`` only lets its forecasts through, however
    often it is there."""
    day = F.col("local_date").between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    days = stock.filter(day).select(unit, item, "local_date")
    plan = plan.withColumnRenamed("local_forecast_date", "local_date").filter(day)
    rows = plan.join(days, [unit, item, "local_date"], "left_semi").join(items, item).join(units, unit)
    rows = interval_join(rows, volumes, [item], "local_date", "valid_from", "valid_to", closed="both", how="left")
    rows = rows.select(
        F.concat_ws(".", "business_unit_type", F.col("business_unit_code").cast("string")).alias("business_unit"),
        F.concat("item_type", F.col(item).cast("string")).alias("item_id"), F.col("local_date").alias("calendar_date"),
        F.round("operational_forecast", 2).alias("forecast_stock_current_day"), F.round("net", 2).alias("forecast_volume_current_day")).distinct()
    w = Window.partitionBy("business_unit", "item_id").orderBy("calendar_date")
    return rows.withColumns({f"forecast_{kind}_{when}_day": f(f"forecast_{kind}_current_day").over(w)
                             for when, f in (("previous", F.lag), ("next", F.lead)) for kind in ("stock", "volume")})
