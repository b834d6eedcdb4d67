"""K8 deviation labelling: events in status intervals, first event, stages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordertide.operators.relational import asof_join, latest_per_key
from ordertide.fixed import (STAGE_FULFILMENT, STAGE_ORDER_PROCESSING, STATUS_ALLOCATED, STATUS_CREATED,
                             STATUS_SENT)


def status_stage(status: Column) -> Column:
    """Order stage of a line status."""
    return (F.when(status.isin(STATUS_CREATED, STATUS_ALLOCATED), F.lit(STAGE_ORDER_PROCESSING))
            .when(status == STATUS_SENT, F.lit(STAGE_FULFILMENT)))


def overridden_stage(stage: Column, occurrence: Column) -> Column:
    """The event's own stage overrides the status stage when they differ."""
    return (F.when(stage == occurrence, stage)
            .when(stage != occurrence, occurrence)
            .otherwise(stage))


def label_status_intervals(statuses: DataFrame, events: DataFrame, flag_events: DataFrame,
                           by: Sequence[str], status: str, start: str, end: str, event_ts: str,
                           event_cols: Sequence[str], flag_name: str, occurrence: str,
                           bucket: str = "7 days") -> DataFrame:
    """Attach to each status interval ``[start, end)`` its first event and a
    flag telling whether any ``flag_events`` fell inside it.

    Intervals of one key tile the time axis, so an event can only lie in the interval
    that began last before it: an as-of lookup (split by ``bucket`` of time) and a check
    of the end find it, a top-1 per interval the first event, and an equi left join
    brings both back.  No range join, no fan-out, no job while the plan is built.
    """
    by = list(by)
    ikey = [*by, status, start]
    spans = statuses.select(*ikey, end)

    def inside(events: DataFrame, ts: str) -> DataFrame:
        found = asof_join(events, spans, by, ts, start, [status, start, end], bucket=bucket)
        return found.filter(F.col(ts) < F.col(end))

    first = latest_per_key(inside(events.select(*by, event_ts, *event_cols), event_ts), ikey, [F.asc(event_ts)]).select(
        *ikey, event_ts, *event_cols)
    hit = inside(flag_events.select(*by, event_ts), event_ts).select(*ikey).distinct().withColumn(flag_name, F.lit(1))
    out = (statuses.join(first, ikey, "left").join(hit, ikey, "left")
           .withColumn(flag_name, F.coalesce(F.col(flag_name), F.lit(0))))
    out = out.withColumn("order_stage_statuses", status_stage(F.col(status)))
    return out.withColumn("order_stage_deviation",
                          overridden_stage(F.col("order_stage_statuses"), F.col(occurrence)))
