"""K8 deviation labelling (B10, B19, C10j, E2) on the events table."""

from __future__ import annotations

from pyspark.sql import functions as F

from ordertide.catalog import query, table
from ordertide.functions.predicates import reason_code_filter
from ordertide.operators.relational import close_intervals
from ordertide.plans.labels import label_status_intervals

AS_OF = "2024-02-01 00:00:00"

_SQL = f"""
WITH ev AS (
  SELECT event_id, user_id, ts AS event_time,
         CASE event_type WHEN 'error' THEN 'Deviation' WHEN 'click' THEN 'Auto-recovery' ELSE 'Other' END AS event_kind,
         CASE WHEN value < 10 THEN 'NO STOCK' WHEN value < 20 THEN 'NO SUPPLY' WHEN value < 30 THEN 'QUAL BLOCK'
              ELSE 'OTHER' END AS deviation_reason_code,
         CASE WHEN value < 15 THEN 'ORDER PROCESSING' ELSE 'FULFILMENT' END AS deviation_occurence,
         CASE WHEN value >= 25 THEN event_id END AS auto_recovered_line
  FROM events),
st AS (SELECT user_id, ['Created', 'Allocated', 'Sent for fulfillment'][list_position(['signup', 'view', 'purchase'], event_type)] AS status, ts AS t0,
              coalesce((SELECT min(n.ts) FROM events n WHERE n.user_id = events.user_id AND n.ts > events.ts
                         AND n.event_type IN ('signup', 'view', 'purchase')), TIMESTAMP '{AS_OF}') AS t1
       FROM events WHERE event_type IN ('signup', 'view', 'purchase')),
-- per interval its earliest listed event, and whether an event without stock lies in it
hit AS (SELECT st.*, min(ROW(ev.event_time, ev.event_kind, ev.deviation_reason_code, ev.deviation_occurence)) FILTER (
                 (event_kind = 'Deviation' AND deviation_reason_code IN ('NO SUPPLY', 'QUAL BLOCK') AND event_time >= TIMESTAMP '2024-01-03'
                  AND event_time < TIMESTAMP '{AS_OF}') OR (event_kind = 'Auto-recovery' AND auto_recovered_line IS NOT NULL)) AS e,
               coalesce(bool_or(deviation_reason_code = 'NO STOCK'), FALSE) AS no_stock
        FROM st LEFT JOIN ev ON ev.user_id = st.user_id AND ev.event_time >= st.t0 AND ev.event_time < st.t1 GROUP BY ALL),
lab AS (SELECT *, if(status LIKE 'Sent%', 'FULFILMENT', 'ORDER PROCESSING') AS stage FROM hit)
SELECT user_id, status AS line_status_description, t0 AS line_status_date, t1 AS next_line_status_date, e[1] AS event_time, e[2] AS event_kind,
       e[3] AS deviation_reason_code, e[4] AS deviation_occurence, CAST(no_stock AS INT) AS has_no_stock_deviation, stage AS order_stage_statuses,
       coalesce(e[4], stage) AS order_stage_deviation
FROM lab
"""


@query("deviation_labels", oracle=_SQL)
def deviation_labels(spark, sf):
    """K8: status intervals labelled with their first deviation / auto-recovery."""
    e = table(spark, sf, "events")
    v = F.col("value")
    ev = e.select(
        "event_id", "user_id", F.col("ts").alias("event_time"),
        F.when(F.col("event_type") == "error", "Deviation").when(F.col("event_type") == "click", "Auto-recovery")
        .otherwise("Other").alias("event_kind"),
        F.when(v < 10, "NO STOCK").when(v < 20, "NO SUPPLY").when(v < 30, "QUAL BLOCK").otherwise("OTHER")
        .alias("deviation_reason_code"),
        F.when(v < 15, "ORDER PROCESSING").otherwise("FULFILMENT").alias("deviation_occurence"),
        F.when(v >= 25, F.col("event_id")).alias("auto_recovered_line"))
    st = (e.filter(F.col("event_type").isin("signup", "view", "purchase"))
          .select("user_id",
                  F.when(F.col("event_type") == "signup", "Created").when(F.col("event_type") == "view", "Allocated")
                  .otherwise("Sent for fulfillment").alias("line_status_description"),
                  F.col("ts").alias("line_status_date")))
    st = close_intervals(st, ["user_id"], "line_status_date", "next_line_status_date",
                         F.lit(AS_OF).cast("timestamp_ntz"))
    t = F.col("event_time")
    dev = ev.filter(reason_code_filter(
        reason_ok=F.col("deviation_reason_code").isin("NO SUPPLY", "QUAL BLOCK"),
        date_from_ok=F.to_date(t) >= F.lit("2024-01-03").cast("date"),
        event_from_ok=t < F.lit(AS_OF).cast("timestamp_ntz"),
        is_deviation=F.col("event_kind") == "Deviation",
        is_recovery=F.col("event_kind") == "Auto-recovery",
        recovered_ok=F.col("auto_recovered_line").isNotNull()))
    ns = ev.filter(F.col("deviation_reason_code") == "NO STOCK")
    out = label_status_intervals(st, dev, ns, ["user_id"], "line_status_description", "line_status_date",
                                 "next_line_status_date", "event_time",
                                 ["event_kind", "deviation_reason_code", "deviation_occurence"],
                                 "has_no_stock_deviation", "deviation_occurence")
    return out.select("user_id", "line_status_description", "line_status_date", "next_line_status_date",
                      "event_time", "event_kind", "deviation_reason_code", "deviation_occurence",
                      "has_no_stock_deviation", "order_stage_statuses", "order_stage_deviation")


@query("stage_override", oracle=f"SELECT order_stage_statuses, deviation_occurence, order_stage_deviation, count(*) AS n_intervals FROM ({_SQL}) GROUP BY ALL")
def stage_override(spark, sf):
    """Status stage vs event stage override, counted per combination."""
    d = deviation_labels(spark, sf)
    return (d.groupBy("order_stage_statuses", "deviation_occurence", "order_stage_deviation")
            .agg(F.count(F.lit(1)).alias("n_intervals")))
