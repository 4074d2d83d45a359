"""Missing values, duplicates and gaps (C)."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.common import EVENTS, GAPPY, OBS, PANEL, PANEL_COLUMNS, PANEL_DOUBLES, check, panel_select, rd, rounded
from rainpanel.operators import quality
from rainpanel.plans import star

NUMERIC = (
    "precipitations", "temperature_min", "temperature_max", "humidite", "pression",
    "latitude", "longitude", "altitude", "distance_cote", "vent",
)
INTEGERS = ("altitude", "distance_cote", "vent")


def profile_sql(source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) AS n_rows, count(*) FILTER (WHERE {c} IS NULL) AS nulls FROM {source}"
        for c in PANEL_COLUMNS
    )


def cleaned_sql() -> str:
    """The rule replayed column by column: drop rows or fill the mean of what is left so far."""
    ratios = ", ".join(f"(count(*) - count({c})) / count(*)::DOUBLE AS {c}" for c in NUMERIC)
    text, previous = f"{GAPPY}, share AS MATERIALIZED (SELECT {ratios} FROM gappy)", "gappy"
    for i, c in enumerate(NUMERIC):
        mean = f"(SELECT avg({c}) FROM {previous})"
        mean = f"CAST(trunc({mean}) AS INTEGER)" if c in INTEGERS else mean
        text += f""", step{i} AS MATERIALIZED (
  SELECT p.* REPLACE (CASE WHEN s.{c} > 0.05 THEN coalesce(p.{c}, {mean}) ELSE p.{c} END AS {c})
  FROM {previous} p, share s WHERE s.{c} > 0.05 OR p.{c} IS NOT NULL)"""
        previous = f"step{i}"
    return text + f", cleaned AS (SELECT * REPLACE (coalesce(type_sol, 'Standard') AS type_sol) FROM {previous})"


CLEANED = cleaned_sql()


@check("c1_missing_profile", f"""
WITH {GAPPY}, profile AS ({profile_sql('gappy')})
SELECT "column", n_rows, nulls, {rd('nulls / n_rows::DOUBLE')} AS ratio FROM profile""")
def missing_profile(spark, sf):
    return rounded(quality.missing_profile(star.gappy_observations(spark, sf)))


ACTIONS = f"""
actions AS (
  SELECT "column", n_rows, nulls, nulls / n_rows::DOUBLE AS ratio,
    CASE WHEN nulls = 0 THEN 'keep'
      WHEN "column" IN {NUMERIC} THEN CASE WHEN nulls / n_rows::DOUBLE > 0.05 THEN 'fill_mean' ELSE 'drop_rows' END
      WHEN "column" = 'type_sol' THEN 'fill_constant' ELSE 'keep' END AS action
  FROM ({profile_sql('gappy')})
)"""


@check("c2_cleaning_decisions", f"""
WITH {GAPPY}, {ACTIONS} SELECT "column", {rd('ratio')} AS ratio, action FROM actions""")
def cleaning_decisions(spark, sf):
    report = quality.quality_report(star.gappy_observations(spark, sf))
    return rounded(report.select("column", "ratio", "action"))


@check("c3_clean", f"WITH {CLEANED} {panel_select('cleaned')}")
def clean(spark, sf):
    return rounded(quality.clean(star.gappy_observations(spark, sf)))


@check("c4_integer_mean", f"WITH {CLEANED} SELECT region, vent, count(*) AS n FROM cleaned GROUP BY 1, 2")
def integer_mean(spark, sf):
    cleaned = quality.clean(star.gappy_observations(spark, sf))
    return cleaned.groupBy("region", "vent").agg(F.count(F.lit(1)).alias("n"))


@check("c5_constant_soil", f"WITH {CLEANED} SELECT region, type_sol, count(*) AS n FROM cleaned GROUP BY 1, 2")
def constant_soil(spark, sf):
    cleaned = quality.clean(star.gappy_observations(spark, sf))
    return cleaned.groupBy("region", "type_sol").agg(F.count(F.lit(1)).alias("n"))


@check("c6_quality_report", f"""
WITH {CLEANED}, {ACTIONS}, after AS ({profile_sql('cleaned')})
SELECT "column", a.nulls AS nulls_before, b.nulls AS nulls_after, {rd('a.ratio')} AS ratio, a.action,
  a.n_rows AS rows_before, b.n_rows AS rows_after
FROM actions a JOIN after b USING ("column")""")
def quality_report(spark, sf):
    return rounded(quality.quality_report(star.gappy_observations(spark, sf)))


def _default(c: str) -> str:
    if c == "type_sol":
        return "coalesce(type_sol, 'Standard') AS type_sol"
    if c in INTEGERS:
        return f"coalesce({c}, 0) AS {c}"
    if c in PANEL_DOUBLES and c != "precipitations":
        return f"{rd(f'coalesce({c}, 0.0)')} AS {c}"
    return f"{rd(c)} AS {c}" if c == "precipitations" else c


@check("c7_fill_defaults", f"WITH {GAPPY} SELECT {', '.join(_default(c) for c in PANEL_COLUMNS)} FROM gappy")
def fill_defaults(spark, sf):
    return rounded(quality.fill_defaults(star.gappy_observations(spark, sf)))


REST = [c for c in PANEL_COLUMNS if c not in ("region", "date")]


@check("c8_deduplicate", f"""
WITH {OBS}, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY region, date ORDER BY {', '.join(f'{c} NULLS FIRST' for c in REST)}) AS rn FROM obs
) {panel_select('ranked')} WHERE rn = 1""")
def deduplicate(spark, sf):
    return rounded(quality.deduplicate(star.observations(spark, sf).select(*PANEL_COLUMNS)))


def densified(source: str, whole_months: bool) -> str:
    lo, hi = ("date_trunc('month', min(date))", "last_day(max(date))") if whole_months else ("min(date)", "max(date)")
    return f"""
calendar AS (
  SELECT region, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date
  FROM (SELECT region, CAST({lo} AS TIMESTAMP) AS lo, CAST({hi} AS TIMESTAMP) AS hi FROM {source} GROUP BY region)
),
dense AS (
  SELECT c.region, c.date, coalesce(p.precipitations, 0.0) AS precipitations
  FROM calendar c LEFT JOIN {source} p ON p.region = c.region AND p.date = c.date
)"""


@check("c9_densify", f"WITH {PANEL}, {densified('panel', True)} SELECT region, date, {rd('precipitations')} AS precipitations FROM dense")
def densify(spark, sf):
    return rounded(quality.densify(star.panel(spark, sf)))


@check("c9_densify_span", f"WITH {EVENTS}, {densified('event_panel', False)} SELECT region, date, {rd('precipitations')} AS precipitations FROM dense")
def densify_span(spark, sf):
    return rounded(quality.densify(star.event_panel(spark, sf), whole_months=False))


HOLES = "CASE WHEN day(date) % 5 = 0 THEN NULL ELSE precipitations END"


@check("c9_densify_gappy", f"""
WITH {PANEL}, holes AS (SELECT * REPLACE ({HOLES} AS precipitations) FROM panel), {densified('holes', True)}
SELECT region, date, {rd('CASE WHEN h.region IS NULL THEN d.precipitations ELSE h.precipitations END')} AS precipitations
FROM dense d LEFT JOIN (SELECT region, date, precipitations FROM holes) h USING (region, date)""")
def densify_gappy(spark, sf):
    """Recorded days whose measure is missing stay missing; days without a record become 0."""
    return rounded(quality.densify(star.panel(spark, sf).withColumn("precipitations", F.expr(HOLES))))
