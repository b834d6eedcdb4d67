"""K13 recovery analysis: attempts = purchase events per user, success = qty > 0."""

from __future__ import annotations

from pyspark.sql import functions as F

from ordertide.catalog import query, table
from ordertide.plans import recovery as R

DELIVERY = ["user_id"]

_SQL_ATTEMPTS = """
WITH a0 AS (
  SELECT e.user_id, e.event_id, e.ts, n.n_name AS country_code,
         CAST(row_number() OVER (PARTITION BY e.user_id ORDER BY e.ts, e.event_id) AS BIGINT) AS ar_attempt_seq,
         CASE WHEN floor(e.value / 25) > 0 THEN 1 ELSE 0 END AS successful_AR
  FROM events e LEFT JOIN customer c ON c.c_custkey = e.user_id
  LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
  WHERE e.event_type = 'purchase'),
a AS (SELECT *, 1 - successful_AR AS unsuccessful_AR,
             max(successful_AR) OVER (PARTITION BY user_id) AS ever_successful FROM a0)
"""


def attempts(spark, sf):
    e = table(spark, sf, "events").filter(F.col("event_type") == "purchase")
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf, "nation").select("n_nationkey", F.col("n_name").alias("country_code"))
    e = (e.join(c, e.user_id == c.c_custkey, "left")
         .join(F.broadcast(n), F.col("c_nationkey") == n.n_nationkey, "left"))  # 25-row dimension
    e = e.select("user_id", "event_id", "ts", "country_code", "value")
    return R.sequence_attempts(e, DELIVERY, "ts", F.floor(F.col("value") / 25) > 0, ["event_id"])


@query("attempt_distribution", oracle=_SQL_ATTEMPTS + """,
f AS (SELECT user_id, min(ar_attempt_seq) AS first_success_attempt FROM a WHERE successful_AR = 1 GROUP BY user_id),
d AS (SELECT first_success_attempt, count(*) AS n_deliveries FROM f GROUP BY first_success_attempt)
SELECT first_success_attempt, n_deliveries,
       round(100.0 * n_deliveries / sum(n_deliveries) OVER (), 4) AS pct_deliveries FROM d
""")
def attempt_distribution(spark, sf):
    return R.first_success_distribution(attempts(spark, sf), DELIVERY)


@query("attempt_breakdown", oracle=_SQL_ATTEMPTS + """
SELECT ar_attempt_seq, count(*) AS n_attempts, CAST(sum(successful_AR) AS BIGINT) AS n_successful,
       round(100 * avg(successful_AR), 4) AS success_rate_pct
FROM a GROUP BY ar_attempt_seq
""")
def attempt_breakdown(spark, sf):
    return R.attempt_breakdown(attempts(spark, sf))


@query("country_breakdown", oracle=_SQL_ATTEMPTS + """
SELECT country_code, count(DISTINCT user_id) AS n_deliveries,
       count(DISTINCT user_id) FILTER (ever_successful = 1) AS ever_successful,
       count(DISTINCT user_id) FILTER (ever_successful = 0) AS never_successful,
       round(100.0 * count(DISTINCT user_id) FILTER (ever_successful = 1) / count(DISTINCT user_id), 4) AS success_rate_pct
FROM a GROUP BY country_code
""")
def country_breakdown(spark, sf):
    return R.country_breakdown(attempts(spark, sf), DELIVERY, "country_code")


@query("recovery_after_failure", oracle=_SQL_ATTEMPTS + """,
ff AS (SELECT user_id FROM a WHERE ar_attempt_seq = 1 AND successful_AR = 0),
per AS (SELECT user_id, max(successful_AR) AS recovered FROM a WHERE user_id IN (SELECT user_id FROM ff)
        GROUP BY user_id)
SELECT count(*) AS n_first_failed, CAST(sum(recovered) AS BIGINT) AS n_recovered,
       round(100.0 * sum(recovered) / count(*), 4) AS recovery_rate_pct FROM per
""")
def recovery_after_failure(spark, sf):
    """C22j + D15: semi-join on the deliveries whose first attempt failed."""
    return R.recovery_after_failure(attempts(spark, sf), DELIVERY)


@query("semi_join_first_failed", oracle=_SQL_ATTEMPTS + """
SELECT user_id, ar_attempt_seq, successful_AR FROM a
WHERE user_id IN (SELECT user_id FROM a WHERE ar_attempt_seq = 1 AND successful_AR = 0)
""")
def semi_join_first_failed(spark, sf):
    """C22j: attempts of the deliveries whose first attempt failed (left semi join)."""
    a = attempts(spark, sf)
    ff = a.filter((F.col("ar_attempt_seq") == 1) & (F.col("successful_AR") == 0)).select("user_id")
    return a.join(ff, "user_id", "left_semi").select("user_id", "ar_attempt_seq", "successful_AR")


@query("key_metrics", oracle=_SQL_ATTEMPTS + """,
r AS (SELECT user_id, max(ever_successful) AS ever_successful, 1 - max(ever_successful) AS never_successful,
             max(CASE WHEN ar_attempt_seq = 1 THEN successful_AR END) AS first_attempt_success,
             min(CASE WHEN successful_AR = 1 THEN ar_attempt_seq END) AS first_success_attempt
      FROM a GROUP BY user_id),
m AS (SELECT CAST(count(*) AS DOUBLE) AS total_deliveries,
             CAST(sum(ever_successful) AS DOUBLE) AS ever_successful,
             CAST(sum(never_successful) AS DOUBLE) AS never_successful,
             round(100.0 * sum(ever_successful) / count(*), 4) AS ever_successful_pct,
             CAST(sum(first_attempt_success) AS DOUBLE) AS first_attempt_success,
             round(100.0 * sum(first_attempt_success) / count(*), 4) AS first_attempt_success_pct,
             round(avg(first_success_attempt), 4) AS mean_attempts_to_success,
             round(100.0 * count(*) FILTER (WHERE first_success_attempt > 1) / nullif(sum(ever_successful), 0), 4)
               AS later_attempt_success_pct,
             round(100.0 * avg(never_successful), 4) AS never_successful_pct,
             round(100.0 * avg(ever_successful) FILTER (first_attempt_success = 0), 4) AS recovery_after_first_failure_pct
      FROM r)
UNPIVOT m ON COLUMNS(*) INTO NAME metric VALUE value
""")
def key_metrics(spark, sf):
    roll = R.delivery_rollup(attempts(spark, sf), DELIVERY, "country_code")
    return R.key_metrics(roll)


@query("flag_consistency", oracle="""
SELECT user_id, count(DISTINCT value >= 25) AS n_successful_AR, count(DISTINCT event_id % 2) AS n_recorded, 
       CAST(count(DISTINCT value >= 25) <= 1 AND count(DISTINCT event_id % 2) <= 1 AS INT) AS consistent
FROM events WHERE event_type = 'purchase' GROUP BY user_id
""")
def flag_consistency(spark, sf):
    """D19 on flags that each row carries."""
    e = table(spark, sf, "events").filter("event_type = 'purchase'").select(
        "user_id", (F.col("value") >= 25).cast("int").alias("successful_AR"), (F.col("event_id") % 2).alias("recorded"))
    return R.flag_consistency(e, DELIVERY, ["successful_AR", "recorded"])


@query("delivery_rollup", oracle=_SQL_ATTEMPTS + """
SELECT user_id, count(*) AS n_attempts, CAST(sum(successful_AR) AS BIGINT) AS n_successful,
       min(country_code) AS country_code, max(ever_successful) AS ever_successful,
       max(1 - ever_successful) AS never_successful,
       max(CASE WHEN ar_attempt_seq = 1 THEN successful_AR END) AS first_attempt_success,
       min(CASE WHEN successful_AR = 1 THEN ar_attempt_seq END) AS first_success_attempt
FROM a GROUP BY user_id
""")
def delivery_rollup(spark, sf):
    """Per-delivery roll-up (B29 composite ids are not needed: one key column)."""
    return R.delivery_rollup(attempts(spark, sf), DELIVERY, "country_code")
