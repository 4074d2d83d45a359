"""Registry, shared SQL and helpers of the registered queries."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from rainpanel.schema import SCHEMA

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def check(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name`` with its SQL, if it has one."""
    def register(query: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = query
        if sql is not None:
            SQL[name] = sql
        return query
    return register


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, so the order of additions does not show."""
    doubles = [f.name for f in df.schema if isinstance(f.dataType, T.DoubleType)]
    return df.withColumns({c: F.round(c, digits) + F.lit(0.0) for c in doubles}) if doubles else df


def rd(expression: str, digits: int = 6) -> str:
    """The SQL twin of ``rounded``; adding zero turns -0.0 into 0.0."""
    return f"(round(CAST({expression} AS DOUBLE), {digits}) + 0.0)"


def scratch(spark: SparkSession) -> str:
    """A new folder path in the session's shared checkpoint folder.

    Only a session on a single machine may do without that setting; it gets a temporary folder.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if base is None:
        if not (context.master == "local" or context.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="rainpanel-checkpoint-"))
        base = context.getCheckpointDir()
    return f"{base.rstrip('/')}/rainpanel-{uuid.uuid4().hex}"


PANEL_COLUMNS = tuple(SCHEMA.fieldNames())
PANEL_DOUBLES = tuple(f.name for f in SCHEMA if isinstance(f.dataType, T.DoubleType))

_PARTS = """CAST(year(date) AS INTEGER) AS annee, CAST(month(date) AS INTEGER) AS mois,
    CAST(day(date) AS INTEGER) AS jour"""

OBS = f"""
raw_obs AS (
  SELECT n_name AS region, CAST(l_shipdate AS DATE) AS date,
    CASE WHEN l_returnflag = 'N' THEN 0.0::DOUBLE ELSE l_quantity END AS precipitations,
    CAST(floor(l_discount * 100 + 0.5) AS DOUBLE) AS temperature_min,
    CAST(floor(l_tax * 100 + 0.5) AS DOUBLE) AS temperature_max,
    l_quantity AS humidite, l_linenumber AS vent, CAST(floor(l_extendedprice) AS DOUBLE) AS pression,
    CAST(n_nationkey AS DOUBLE) AS latitude, CAST(n_regionkey AS DOUBLE) AS longitude,
    n_nationkey AS altitude, c_mktsegment AS type_sol, n_regionkey AS distance_cote
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
),
obs AS (SELECT *, {_PARTS} FROM raw_obs)"""

GAPPY = OBS + """,
gappy AS (
  SELECT * REPLACE (
    nullif(precipitations, 50.0) AS precipitations, nullif(temperature_min, 0.0) AS temperature_min,
    nullif(temperature_max, 0.0) AS temperature_max,
    CASE WHEN pression >= 1500 THEN pression END AS pression,
    nullif(vent, 1) AS vent, nullif(type_sol, 'MACHINERY') AS type_sol)
  FROM obs
)"""

PANEL = OBS + f""",
daily AS (
  SELECT region, date, sum(precipitations) AS precipitations, avg(temperature_min) AS temperature_min,
    avg(temperature_max) AS temperature_max, avg(humidite) AS humidite, max(vent) AS vent,
    avg(pression) AS pression, max(latitude) AS latitude, max(longitude) AS longitude,
    max(altitude) AS altitude, min(type_sol) AS type_sol, max(distance_cote) AS distance_cote
  FROM obs GROUP BY region, date
),
panel AS (SELECT *, {_PARTS} FROM daily)"""

EVENTS = f"""
event_daily AS (
  SELECT event_type AS region, CAST(ts AS DATE) AS date, CAST(sum(floor(value)) AS DOUBLE) AS precipitations
  FROM events GROUP BY 1, 2
),
event_panel AS (SELECT *, {_PARTS} FROM event_daily)"""


def panel_select(source: str = "panel", columns: tuple[str, ...] = PANEL_COLUMNS) -> str:
    """Select list of panel columns with doubles rounded."""
    names = [f"{rd(c)} AS {c}" if c in PANEL_DOUBLES else c for c in columns]
    return f"SELECT {', '.join(names)} FROM {source}"
