"""More join shapes: C19j, C20j, C21j (+ valid-at), C26j, F4 with B6."""

from __future__ import annotations

from pyspark.sql import functions as F

from ordertide.catalog import ORACLES, query, table
from ordertide.catalog._common import SQL_CHANGE_LOG, change_log
from ordertide.operators.relational import latest_per_key, valid_at


@query("same_day_join", oracle=f"""
WITH b AS ({SQL_CHANGE_LOG}),
s AS (SELECT item_id, CAST(modify_date_time AS DATE) AS snapshot_date,
             arg_max(availability_qty, modify_date_time) AS end_of_day_qty
      FROM b GROUP BY item_id, CAST(modify_date_time AS DATE))
SELECT e.event_id, e.user_id, e.ts, s.end_of_day_qty
FROM events e JOIN s ON s.item_id = e.user_id AND s.snapshot_date = CAST(e.ts AS DATE)
WHERE e.event_type = 'error'
""")
def same_day_join(spark, sf):
    """C19j: DATE(ts) = date plus keys, as an equi join on a derived date."""
    snap = (change_log(spark, sf).groupBy("item_id", F.to_date("modify_date_time").alias("snapshot_date"))
            .agg(F.max_by("availability_qty", "modify_date_time").alias("end_of_day_qty")))
    e = table(spark, sf, "events").filter(F.col("event_type") == "error").withColumn("d", F.to_date("ts"))
    j = e.join(snap, (e.user_id == snap.item_id) & (e.d == snap.snapshot_date))
    return j.select("event_id", "user_id", "ts", "end_of_day_qty")


@query("lag_day_join", oracle="""
WITH d AS (SELECT o_orderpriority, CAST(o_orderdate AS DATE) AS order_date, count(*) AS n_orders
           FROM orders GROUP BY ALL)
SELECT a.o_orderpriority, a.order_date, a.n_orders, b.n_orders AS n_orders_previous_day
FROM d a LEFT JOIN d b ON b.o_orderpriority = a.o_orderpriority AND b.order_date = a.order_date - 1
""")
def lag_day_join(spark, sf):
    """C20j: join on DATE = DATE_SUB(calendar_date, 1)."""
    d = (table(spark, sf, "orders").groupBy("o_orderpriority", F.to_date("o_orderdate").alias("order_date"))
         .agg(F.count(F.lit(1)).alias("n_orders")))
    prev = d.select(F.col("o_orderpriority").alias("p"), F.date_add("order_date", 1).alias("next_day"),
                    F.col("n_orders").alias("n_orders_previous_day"))
    j = d.join(prev, (d.o_orderpriority == prev.p) & (d.order_date == prev.next_day), "left")
    return j.select("o_orderpriority", "order_date", "n_orders", "n_orders_previous_day")


def _sl_events(spark, sf):
    from ordertide.catalog.calendar import change_string_parse
    sl = change_string_parse(spark, sf)
    e = table(spark, sf, "events")
    ev = e.select("event_id", F.col("event_id").cast("string").alias("item_id"),
                  F.concat(F.upper("event_type"), F.lit("."), F.lpad(F.col("user_id").cast("string"), 3, "0"))
                  .alias("ship_node"), F.to_date("ts").alias("event_date"))
    return sl, ev


@query("scd_fanout_join")
def scd_fanout_join(spark, sf):
    """C21j as written: every service-level change of the item (row fan-out)."""
    sl, ev = _sl_events(spark, sf)
    j = ev.join(sl, ["ship_node", "item_id"], "left")
    return j.select("event_id", "ship_node", "item_id", "event_date", F.col("to_SL").alias("item_id_service_level"),
                    "change_date")


@query("scd_valid_at")
def scd_valid_at(spark, sf):
    """C21j variant: the level valid at the event date (as-of on change_date)."""
    sl, ev = _sl_events(spark, sf)
    return valid_at(ev, sl.select("ship_node", "item_id", "change_date", "to_SL"), ["ship_node", "item_id"],
                    "event_date", "change_date", ["to_SL", "change_date"], bucket="30 days")


_SQL_SL = f"WITH sl AS ({ORACLES['change_string_parse']}"
ORACLES["scd_fanout_join"] = _SQL_SL.rstrip() + """),
ev AS (SELECT event_id, CAST(event_id AS VARCHAR) AS item_id,
              upper(event_type) || '.' || lpad(CAST(user_id AS VARCHAR), 3, '0') AS ship_node,
              CAST(ts AS DATE) AS event_date FROM events)
SELECT ev.event_id, ev.ship_node, ev.item_id, ev.event_date, sl.to_SL AS item_id_service_level, sl.change_date
FROM ev LEFT JOIN sl ON sl.ship_node = ev.ship_node AND sl.item_id = ev.item_id
"""
ORACLES["scd_valid_at"] = _SQL_SL.rstrip() + """),
ev AS (SELECT event_id, CAST(event_id AS VARCHAR) AS item_id,
              upper(event_type) || '.' || lpad(CAST(user_id AS VARCHAR), 3, '0') AS ship_node,
              CAST(ts AS DATE) AS event_date FROM events),
slv AS (SELECT ship_node, item_id, change_date, to_SL FROM sl WHERE change_date IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY ship_node, item_id, change_date ORDER BY to_SL) = 1)
SELECT ev.event_id, ev.item_id, ev.ship_node, ev.event_date, slv.to_SL, slv.change_date
FROM ev ASOF LEFT JOIN slv ON slv.ship_node = ev.ship_node AND slv.item_id = ev.item_id
                           AND ev.event_date >= slv.change_date
"""


@query("status_pivot", oracle="""
WITH p AS (SELECT l_orderkey, l_linenumber,
                  min(CASE WHEN l_returnflag = 'A' THEN l_shipdate END) AS created_date,
                  max(CASE WHEN l_returnflag = 'R' THEN l_shipdate END) AS acknowledged_date
           FROM lineitem GROUP BY l_orderkey, l_linenumber),
l AS (SELECT l_orderkey, l_linenumber, l_shipdate FROM lineitem
      QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
              ORDER BY l_shipdate DESC, l_suppkey DESC, l_partkey DESC, l_quantity DESC, l_extendedprice DESC,
                       l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC) = 1)
SELECT l.*, p.created_date, p.acknowledged_date FROM l JOIN p USING (l_orderkey, l_linenumber)
""")
def status_pivot(spark, sf):
    """C26j: two statuses of one line as two columns - one grouped pass, one join."""
    from ordertide.catalog._common import line_tiebreak_desc
    li = table(spark, sf, "lineitem")
    keys = ["l_orderkey", "l_linenumber"]
    piv = li.groupBy(*keys).agg(
        F.min(F.when(F.col("l_returnflag") == "A", F.col("l_shipdate"))).alias("created_date"),
        F.max(F.when(F.col("l_returnflag") == "R", F.col("l_shipdate"))).alias("acknowledged_date"))
    latest = latest_per_key(li, keys, [F.desc("l_shipdate")], [F.desc("l_suppkey"), *line_tiebreak_desc()])
    return latest.select(*keys, "l_shipdate").join(piv, keys)


@query("top_countries", oracle="""
SELECT n.n_name, count(*) AS n_orders
FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey JOIN nation n ON n.n_nationkey = c.c_nationkey
WHERE o.o_orderpriority NOT IN ('5-LOW', '4-NOT SPECIFIED')
GROUP BY n.n_name ORDER BY n_orders DESC, n.n_name ASC LIMIT 10
""")
def top_countries(spark, sf):
    """F4 + B6: top 10 countries by orders outside two priorities (NOT IN)."""
    from ordertide.functions.predicates import not_in
    o = table(spark, sf, "orders").filter(not_in(F.col("o_orderpriority"), ["5-LOW", "4-NOT SPECIFIED"]))
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf, "nation").select("n_nationkey", "n_name")
    g = (o.join(c, o.o_custkey == c.c_custkey).join(F.broadcast(n), F.col("c_nationkey") == n.n_nationkey)
         .groupBy("n_name").agg(F.count(F.lit(1)).alias("n_orders")))
    return g.orderBy(F.desc("n_orders"), F.asc("n_name")).limit(10)
