"""Registered queries: one per operator of the inventory, each with the
DuckDB SQL that must give the same rows (the correctness oracle).

Every query reads the driver's tables through the fixture views
(``farelake.plans.fixtures``) and runs over whole tables. Floating
aggregates are rounded on both sides (``R``) because summation order differs
between engines; row-level arithmetic is IEEE-identical and left as is.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake import fixed
from farelake.plans import fixtures as fx

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


# ---------------------------------------------------------------------------
# shared helpers for both sides
# ---------------------------------------------------------------------------

def rnd(df: DataFrame, cols, digits: int = 4) -> DataFrame:
    """Round the given double columns (Spark side of ``R``)."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    return df.withColumns({c: F.round(F.col(c), digits) for c in cols})


def R(x: str, digits: int = 4) -> str:
    """SQL rounding with Spark's rule: HALF_UP on the shortest decimal form."""
    return f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,17)), {digits}) AS DOUBLE)"


def DUR(a: str = "pickup_datetime", b: str = "dropoff_datetime") -> str:
    """Minutes between two timestamps as double."""
    return f"(CAST(date_diff('microsecond', {a}, {b}) AS DOUBLE) / CAST(60000000 AS DOUBLE))"


def DAYNAME(x: str) -> str:
    return f"dayname({x})"


def SEASON_PT(month_expr: str) -> str:
    whens = " ".join(f"WHEN {k} THEN '{v}'" for k, v in fixed.SEASON_INDEX_PT.items())
    return f"CASE ({month_expr} % 12) // 3 + 1 {whens} END"


def SEASON_NORTH(m: str) -> str:
    winter, spring, summer, fall = fixed.SEASON_NORTH
    return (f"CASE WHEN {m} = 12 OR {m} <= 2 THEN '{winter}' WHEN {m} <= 5 THEN '{spring}' "
            f"WHEN {m} <= 8 THEN '{summer}' WHEN {m} <= 11 THEN '{fall}' END")


def SQL_LIST(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def SQL_IN(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def SQL_MAP(expr: str, mapping) -> str:
    whens = " ".join(f"WHEN {expr} = '{k}' THEN '{v}'" for k, v in mapping.items())
    return f"CASE {whens} END"


WT = f"WITH t AS ({fx.TRIPS_SQL})"
WZ = f"z AS ({fx.DIM_LOCATION_SQL})"
WE = f"WITH e AS ({fx.EVENTS_SQL})"


def T(spark, d):
    return fx.trips(spark, d)


def Z(spark, d):
    return fx.dim_location_view(spark, d)


def E(spark, d):
    return fx.events_trips(spark, d)


def load_all() -> tuple[dict[str, QueryFn], dict[str, str]]:
    """Import every section (each registers its queries) and return the
    registry: (queries, oracle SQL). Safe to call more than once."""
    import importlib
    for mod in ("q_sources", "q_rules", "q_analytics", "q_warehouse", "q_cubes", "q_heavy"):
        importlib.import_module(f"farelake.plans.{mod}")
    return QUERIES, ORACLE
