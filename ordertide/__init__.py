"""ordertide: order-fulfilment and stock analytics as Spark DataFrame jobs.

Sub-packages
------------
sources    readers, sinks and report writers (Parquet / CSV / tables)
functions  scalar column expressions (time, regex, rounding, ratios)
operators  reusable DataFrame -> DataFrame operators (dedup, as-of and
           interval joins, trailing windows, profiling, preparation,
           statistics and models)
plans      composite jobs built from the operators (availability
           features, z-scores, calendars, order-line status, KPIs ...)
streaming  notes on incremental use (the workload is batch only)
catalog    the query catalogue run against the driver's test tables
"""

from ordertide.session import get_session  # noqa: F401

__all__ = ["get_session"]
