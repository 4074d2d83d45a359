"""Climatology predictions (A12, L1 to L4)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from checks.common import EVENTS, PANEL, check, rd, rounded
from checks.functions import classes
from checks.tables import ASKED, DATES, asked
from rainpanel.operators import climatology, joins
from rainpanel.plans import jobs, star
from rainpanel.schema import WEATHER_COLUMNS

STATS = """avg(precipitations) AS mean, stddev_samp(precipitations) AS sd, count(*) AS n,
    count(DISTINCT annee) AS years, avg(annee) AS mean_year, avg(latitude) AS lat, avg(longitude) AS lon"""


def ladder(source: str, asked_table: str, places: bool = True) -> str:
    """The four steps written as one statistics table per level, then the first that exists."""
    stats = STATS if places else STATS.replace("avg(latitude)", "NULL::DOUBLE").replace("avg(longitude)", "NULL::DOUBLE")

    def level(name: str, keys: str) -> str:
        group = f"GROUP BY {keys}" if keys else ""
        select = f"{keys}, " if keys else ""
        year = f"{keys}, annee" if keys else "annee"
        join = " AND ".join(f"s.{k.strip()} = t.{k.strip()}" for k in keys.split(",")) if keys else "TRUE"
        return f"""
{name}_stats AS (SELECT {select}{stats} FROM {source} {group}),
{name}_slope AS (SELECT {select}regr_slope(m, annee) AS slope FROM
  (SELECT {year}, avg(precipitations) AS m FROM {source} GROUP BY {year}) {group}),
{name} AS (SELECT s.*, CASE WHEN s.years >= 3 THEN coalesce(t.slope, 0) ELSE 0 END AS trend
  FROM {name}_stats s JOIN {name}_slope t ON {join})"""

    # a slice that exists has a count, so its other values are taken from the same level
    def pick(c: str) -> str:
        return (f"CASE WHEN r.n IS NOT NULL THEN CASE WHEN rm.n IS NOT NULL THEN rm.{c} ELSE r.{c} END "
                f"ELSE CASE WHEN m.n IS NOT NULL THEN m.{c} ELSE a.{c} END END AS {c}")

    return ",".join([level("rm", "region, mois"), level("r", "region"), level("m", "mois"), level("a", "")]) + f""",
chosen AS (
  SELECT q.region, q.date, {', '.join(pick(c) for c in ('mean', 'sd', 'n', 'years', 'mean_year', 'trend'))},
    CASE WHEN r.n IS NOT NULL THEN r.lat ELSE a.lat END AS lat, CASE WHEN r.n IS NOT NULL THEN r.lon ELSE a.lon END AS lon
  FROM {asked_table} q CROSS JOIN a LEFT JOIN r ON r.region = q.region
    LEFT JOIN rm ON rm.region = q.region AND rm.mois = month(q.date) LEFT JOIN m ON m.mois = month(q.date)),
predicted AS (SELECT *, greatest(0.0, mean + trend * (year(date) - mean_year)) AS p FROM chosen)"""


def report(where: str = "") -> str:
    return f"""SELECT region, date, {rd('p', 4)} AS precipitation, {rd('sd', 4)} AS std_deviation, {classes('p')} AS category,
  n AS data_points, years AS years_of_data, {rd('trend', 4)} AS annual_trend, {rd('lat', 4)} AS latitude,
  {rd('lon', 4)} AS longitude FROM predicted {where}"""


ON_PANEL = f"{PANEL}, {ASKED}, {ladder('panel', 'asked')}"
KNOWN = "WHERE EXISTS (SELECT 1 FROM observed o WHERE o.region = predicted.region)"


@check("a12_ladder_panel", f"WITH {ON_PANEL} {report()}")
def ladder_panel(spark, sf):
    cells = climatology.rain_cells(star.panel(spark, sf))
    return rounded(climatology.predict(asked(spark, sf), cells), 4)


EVENT_DATES = (dt.date(2024, 1, 15), dt.date(2025, 7, 1))


@check("a12_ladder_missing_months", f"""
WITH {EVENTS}, asked AS (
  SELECT region, date FROM (SELECT DISTINCT region FROM event_panel UNION SELECT r_name FROM region),
    (VALUES (DATE '2024-01-15'), (DATE '2025-07-01')) AS d(date)),
{ladder('event_panel', 'asked', places=False)} {report()}""")
def ladder_missing_months(spark, sf):
    panel = star.event_panel(spark, sf)
    names = panel.select("region").distinct().unionByName(
        spark.read.parquet(f"{sf}/region.parquet").select(F.col("r_name").alias("region")))
    requests = joins.requests_for(names, EVENT_DATES)
    return rounded(climatology.predict(requests, climatology.rain_cells(panel)), 4)


def _soil(keys: str) -> str:
    select = f"{keys}, " if keys else ""
    part = f"PARTITION BY {keys}" if keys else ""
    group = f"GROUP BY {select}type_sol"
    return f"""(SELECT * FROM (SELECT {select}type_sol AS soil,
  row_number() OVER ({part} ORDER BY count(*) DESC, type_sol) AS rn FROM panel {group}) WHERE rn = 1)"""


def _means(keys: str) -> str:
    select, group = (f"{keys}, ", f"GROUP BY {keys}") if keys else ("", "")
    return f"(SELECT {select}" + ", ".join(f"avg({c}) AS {c}" for c in WEATHER_COLUMNS) + f" FROM panel {group})"


def _weather(c: str) -> str:
    value = f"CASE WHEN rm.vent IS NOT NULL THEN rm.{c} WHEN r.vent IS NOT NULL THEN r.{c} ELSE a.{c} END"
    if c in ("vent", "altitude", "distance_cote"):
        return f"CAST(trunc({value}) AS INTEGER) AS {c}"
    return f"{rd(value)} AS {c}"


@check("a12_ladder_scoring", f"""
WITH {PANEL}, {ASKED}
SELECT q.region, q.date, CAST(year(q.date) AS INTEGER) AS annee, CAST(month(q.date) AS INTEGER) AS mois,
  CAST(day(q.date) AS INTEGER) AS jour, 0.0::DOUBLE AS precipitations, {', '.join(_weather(c) for c in WEATHER_COLUMNS)},
  coalesce(srm.soil, sr.soil, sa.soil) AS type_sol
FROM asked q CROSS JOIN {_means('')} a CROSS JOIN {_soil('')} sa
  LEFT JOIN {_means('region')} r ON r.region = q.region LEFT JOIN {_soil('region')} sr ON sr.region = q.region
  LEFT JOIN {_means('region, mois')} rm ON rm.region = q.region AND rm.mois = month(q.date)
  LEFT JOIN {_soil('region, mois')} srm ON srm.region = q.region AND srm.mois = month(q.date)""")
def ladder_scoring(spark, sf):
    cells = climatology.weather_cells(star.panel(spark, sf))
    return rounded(climatology.expected_weather(asked(spark, sf), cells))


@check("l1_climatology", f"WITH {ON_PANEL} {report(KNOWN)}")
def flagship(spark, sf):
    return rounded(jobs.predict_from_climatology(star.panel(spark, sf), dates=DATES), 4)


def predictions(spark, sf):
    return climatology.predict(asked(spark, sf), climatology.rain_cells(star.panel(spark, sf)), unknown_regions=False)


@check("l2_map_points", f"""
WITH {ON_PANEL} SELECT region, date, {rd('lat', 4)} AS latitude, {rd('lon', 4)} AS longitude, {rd('p', 4)} AS precipitation
FROM predicted {KNOWN} AND lat IS NOT NULL AND lon IS NOT NULL""")
def map_points(spark, sf):
    return rounded(climatology.map_points(predictions(spark, sf)), 4)


@check("l2_map_bounds", f"""
WITH {ON_PANEL} SELECT min(lon) - 0.5 AS x_min, max(lon) + 0.5 AS x_max, min(lat) - 0.5 AS y_min, max(lat) + 0.5 AS y_max
FROM predicted {KNOWN}""")
def map_bounds(spark, sf):
    return climatology.map_bounds(predictions(spark, sf))


@check("l3_summary_table", f"""
WITH {ON_PANEL}, shown AS (SELECT region, date, printf('%.2f', round(p, 2)) AS mm, {classes('p')} AS category FROM predicted {KNOWN})
SELECT *, printf('%-15s %-20s %-15s', region, mm, category) AS line FROM shown""")
def summary_table(spark, sf):
    return climatology.summary_table(predictions(spark, sf))


@check("l4_chart_values", f"""
WITH {ON_PANEL} SELECT region, date, {rd('p', 4)} AS precipitation, {rd('CASE WHEN sd > 0 THEN sd END', 4)} AS error_bar,
  {rd('greatest(1.5 * p, p + 2 * coalesce(sd, 0.0) + 5, 1.0)', 4)} AS axis_top FROM predicted {KNOWN}""")
def chart_values(spark, sf):
    return rounded(climatology.chart_values(predictions(spark, sf)), 4)
