"""Business KPIs (K11) and cancellation analysis."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordertide.operators.relational import latest_per_key


def delivery_totals(lines: DataFrame, delivery_keys: Sequence[str], line_keys: Sequence[str],
                    qty: str, value: str, order_by: Sequence[Column],
                    tiebreak: Sequence[Column] = ()) -> DataFrame:
    """One version per line (latest under ``order_by``), summed per delivery.

    The dedup window is planned with a partial top-1 before its shuffle and the
    delivery sum with a partial aggregate, so both shrink hot keys map-side.
    """
    latest = latest_per_key(lines, [*delivery_keys, *line_keys], order_by, tiebreak)
    return (latest.groupBy(*delivery_keys)
            .agg(F.sum(qty).alias("total_ordered_qty"),
                 F.sum(value).alias("total_euros")))


def delivery_summary(per_delivery: DataFrame, group_by: Sequence[str] = (),
                     places: int = 4) -> DataFrame:
    """Sum and mean of the per-delivery totals, globally or per group."""
    aggs = [F.sum("total_ordered_qty").cast("double").alias("total_ordered_qty"),
            F.sum("total_euros").cast("double").alias("total_euros"),
            F.round(F.avg("total_ordered_qty").cast("double"), places).alias("avg_ordered_qty"),
            F.round(F.avg("total_euros").cast("double"), places).alias("avg_euros"),
            F.count(F.lit(1)).alias("n_deliveries")]
    return per_delivery.groupBy(*group_by).agg(*aggs) if group_by else per_delivery.agg(*aggs)


def nested_key_counts(lines: DataFrame, orders: DataFrame, key: str, group: str, delivery: str, line: str, affected: Column, value: Column) -> DataFrame:
    """KPI distinct counts (D31): orders, deliveries, affected deliveries and affected lines, and
    the affected value (one row).  ``orders`` has the ``key`` and ``group`` of an order; where
    it repeats a row, the lines' value counts again, as in a join of both.

    Lines are dealt by order once and counted there in two sorts: the first row of a
    delivery, and of a line, stands for it, an affected one before others.  Only a row per
    order meets ``orders``.  Null keys are values, as in ``SELECT DISTINCT``."""
    rows = lines.select(key, delivery, line, F.coalesce(affected, F.lit(False)).alias("hit"), value.alias("value")).repartition(key)
    first = lambda c: F.row_number().over(Window.partitionBy(key, c).orderBy(F.desc("hit"))) == 1
    rows = rows.withColumn("__d", first(delivery)).withColumn("__l", first(line))
    per = rows.groupBy(key).agg(F.count_if("__d").alias("n"), F.count_if(F.col("__d") & F.col("hit")).alias("hit"),
                                F.count_if(F.col("__l") & F.col("hit")).alias("lines"), F.sum(F.when(F.col("hit"), F.col("value"))).alias("value"))
    o = orders.select(F.col(key).alias("__k"), F.col(group).alias("__g"))
    per_order = per.join(o, F.col(key) == F.col("__k")).groupBy("__k", "__g").agg(
        *[F.max(c).alias(c) for c in ("n", "hit", "lines")], F.sum("value").alias("value"))
    zero = lambda c: F.coalesce(c, F.lit(0).cast("bigint"))
    return per_order.agg(F.count(F.lit(1)).alias("n_orders"), zero(F.sum("n")).alias("n_deliveries"), zero(F.sum("hit")).alias("n_affected_deliveries"),
                         F.sum("value").cast("double").alias("affected_value"), zero(F.sum("lines")).alias("n_affected_lines"))


def side_by_side(*parts: DataFrame) -> DataFrame:
    """Tables of one row each as one row (without a join)."""
    both = parts[0]
    for p in parts[1:]:
        both = both.unionByName(p, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in both.columns])


def cancellation_by_delivery(lines: DataFrame, delivery_keys: Sequence[str], line_key: str,
                             item: str, order_by: Sequence[Column], flags: Sequence[str],
                             value: str, cancelled: Column, order_key: Sequence[str],
                             seq: Column) -> DataFrame:
    """BC: one row per line -> per delivery with its item list -> last cancel state.

    ``last_cancelled_for_items`` is the cancel flag of the last delivery (by
    ``seq``) of the same order carrying the same item set.
    """
    one = latest_per_key(lines, [*delivery_keys, line_key], order_by)
    per = (one.withColumn("cancelled", cancelled.cast("int"))
           .groupBy(*delivery_keys)
           .agg(F.expr(f"listagg({item}, ', ') WITHIN GROUP (ORDER BY {item})").alias("item_ids"),
                F.max("cancelled").alias("cancelled"),
                *[F.max(f).alias(f) for f in flags],
                F.sum(value).alias("total_euros")))
    w = (Window.partitionBy(*order_key, "item_ids").orderBy(seq)
         .rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return per.withColumn("last_cancelled_for_items", F.last("cancelled").over(w))
