"""Query catalogue: the package's operators applied to the driver's test tables.

Each entry is a callable ``(spark, sf_dir) -> DataFrame`` plus, where the
operator is SQL-expressible, the equivalent DuckDB SQL over the same Parquet
tables.  Role mapping (order line = lineitem joined to orders, ship node =
l_suppkey, item = l_partkey, delivery = (l_orderkey, l_suppkey), change log =
events keyed by user_id with quantity floor(value / 25), deviation =

Comparison conventions shared by queries and oracles: measures are doubles,
money sums go through decimal(18,2) so both engines add exactly, counts are
bigint, float results are rounded to a fixed number of places on both sides,
and every ordering that picks a row carries a full tie-break.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

REGISTRY: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register a catalogue query (and its oracle SQL when it has one)."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle.strip()
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def load_all() -> None:
    """Import every catalogue module so that the registry is filled."""
    import importlib
    for mod in _MODULES:
        importlib.import_module(f"ordertide.catalog.{mod}")


_MODULES = ["kpis", "dedup", "joins", "timeseries", "recovery", "aggregates", "calendar", "labels", "profiling", "prep", "models", "joins2", "notification", "features", "order_lines", "deliveries", "columns", "inspect"]
