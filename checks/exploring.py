"""Aggregates and window-like operators (A, W)."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.common import EVENTS, PANEL, check, rd, rounded
from checks.cleaning import densified
from rainpanel.operators import climatology, explore, features, forecast, models, quality, windows
from rainpanel.plans import star
from rainpanel.schema import WEATHER_COLUMNS

NUMERIC = (
    "annee", "mois", "jour", "precipitations", "temperature_min", "temperature_max", "humidite",
    "vent", "pression", "latitude", "longitude", "altitude", "distance_cote",
)


def _describe(c: str, is_text: bool) -> str:
    nothing = "CAST(NULL AS DOUBLE)"
    if is_text:
        return (f"SELECT '{c}' AS \"column\", count({c}) AS n, {nothing} AS mean, {nothing} AS sd, {nothing} AS min, "
                f"{nothing} AS max, min({c}) AS min_text, max({c}) AS max_text FROM panel")
    return (f"SELECT '{c}' AS \"column\", count({c}) AS n, {rd(f'avg({c})')} AS mean, {rd(f'stddev_samp({c})', 4)} AS sd, "
            f"{rd(f'min({c})')} AS min, {rd(f'max({c})')} AS max, NULL::VARCHAR AS min_text, NULL::VARCHAR AS max_text FROM panel")


@check("a1_describe", f"WITH {PANEL} " + " UNION ALL ".join(
    [_describe(c, False) for c in NUMERIC] + [_describe(c, True) for c in ("region", "type_sol")]))
def describe(spark, sf):
    table = explore.describe_columns(star.panel(spark, sf))
    return rounded(table.withColumn("sd", F.round("sd", 4)))


@check("a2_rows_per_region", f"WITH {PANEL} SELECT region, count(*) AS n FROM panel GROUP BY region ORDER BY n DESC, region")
def rows_per_region(spark, sf):
    return explore.rows_per_region(star.panel(spark, sf))


@check("a3_mean_per_region", f"""
WITH {PANEL} SELECT region, {rd('avg(precipitations)')} AS precipitations_moyennes FROM panel GROUP BY region""")
def mean_per_region(spark, sf):
    return rounded(explore.mean_per_region(star.panel(spark, sf)))


@check("a4_mean_per_month", f"""
WITH {PANEL} SELECT mois, {rd('avg(precipitations)')} AS precipitations_moyennes FROM panel GROUP BY mois ORDER BY mois""")
def mean_per_month(spark, sf):
    return rounded(explore.mean_per_month(star.panel(spark, sf)))


def _weather(group: str, month: str) -> str:
    means = ", ".join(f"{rd(f'avg({c})')} AS {c}" for c in WEATHER_COLUMNS)
    return f"SELECT region, {month} AS mois, {means} FROM panel GROUP BY {group}"


@check("a5_weather_means", f"WITH {PANEL} {_weather('region, mois', 'mois')} UNION ALL {_weather('region', '0')}")
def weather_means(spark, sf):
    return rounded(climatology.weather_means(climatology.weather_cells(star.panel(spark, sf))).select(
        "region", "mois", *WEATHER_COLUMNS
    ))


@check("a6_most_frequent_soil", f"""
WITH {PANEL}, counts AS (SELECT region, mois, type_sol, count(*) AS n FROM panel GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY region, mois ORDER BY n DESC, type_sol) AS rn FROM counts)
SELECT region, mois, type_sol, n FROM ranked WHERE rn = 1""")
def most_frequent(spark, sf):
    return explore.most_frequent(star.panel(spark, sf), ["region", "mois"], "type_sol")


@check("a7_mean_annual_total", f"""
WITH {PANEL} SELECT region, {rd('sum(precipitations)')} AS precipitations, count(DISTINCT annee) AS n_years,
  {rd('sum(precipitations) / count(DISTINCT annee)')} AS precipitations_annuelles FROM panel GROUP BY region""")
def mean_annual_total(spark, sf):
    return rounded(explore.mean_annual_total(star.panel(spark, sf)))


@check("a8_month_profile", f"WITH {PANEL} SELECT region, " + ", ".join(
    rd(f"sum(CASE WHEN mois = {m} THEN precipitations END) / count(DISTINCT annee)") + f" AS m{m}"
    for m in range(1, 13)) + " FROM panel GROUP BY region")
def month_profile(spark, sf):
    return rounded(explore.month_profile(star.panel(spark, sf)))


SERIES = "series AS (SELECT region, CAST(date_trunc('month', date) AS DATE) AS ds, avg(precipitations) AS y FROM panel GROUP BY 1, 2)"


@check("a9_monthly_mean", f"WITH {PANEL}, {SERIES} SELECT region, ds, {rd('y')} AS y FROM series")
def monthly_mean(spark, sf):
    return rounded(explore.monthly_mean(star.panel(spark, sf)))


@check("a10_monthly_mean_by_parts", f"""
WITH {PANEL} SELECT region, annee, mois, {rd('avg(precipitations)')} AS precipitations, make_date(annee, mois, 1) AS ds
FROM panel GROUP BY region, annee, mois ORDER BY region, annee, mois""")
def monthly_mean_by_parts(spark, sf):
    return rounded(explore.monthly_mean_by_parts(star.panel(spark, sf)))


@check("a11_slice_statistics", f"""
WITH {PANEL} SELECT region, mois, {rd('avg(precipitations)')} AS mean, {rd('stddev_samp(precipitations)')} AS std_deviation,
  count(*) AS data_points, count(DISTINCT annee) AS years_of_data, {rd('avg(annee)')} AS mean_year,
  {rd('avg(latitude)')} AS latitude, {rd('avg(longitude)')} AS longitude
FROM panel GROUP BY region, mois""")
def slice_statistics(spark, sf):
    stats = climatology.slice_statistics(climatology.rain_cells(star.panel(spark, sf)))
    return rounded(stats.filter("mois > 0").drop("annual_trend"))


def _slopes(keys: str, month: str, region: str) -> str:
    group = ", ".join(part for part in (keys, "annee") if part)
    outer = f"GROUP BY {keys}" if keys else ""
    return f"""SELECT {region} AS region, {month} AS mois, count(*) AS years_of_data,
  {rd('CASE WHEN count(*) >= 3 THEN regr_slope(m, annee) ELSE 0 END')} AS annual_trend
FROM (SELECT {group}, avg(precipitations) AS m FROM panel GROUP BY {group}) {outer}"""


@check("a13_annual_slope", f"""
WITH {PANEL} {_slopes('region, mois', 'mois', 'region')} UNION ALL {_slopes('region', '0', 'region')}
UNION ALL {_slopes('mois', 'mois', "'*'")} UNION ALL {_slopes('', '0', "'*'")}""")
def annual_slope(spark, sf):
    cells = climatology.rain_cells(star.panel(spark, sf))
    overall = climatology.overall_statistics(cells).withColumn("region", F.lit("*"))
    both = climatology.slice_statistics(cells).unionByName(overall)
    return rounded(both.select("region", "mois", "years_of_data", "annual_trend"))


HISTORY = f"{PANEL}, {SERIES}, fc AS (SELECT region, ds, y AS yhat FROM series)"
REPORT = """
yearly AS (SELECT region, CAST(year(ds) AS INTEGER) AS year, avg(yhat) AS v FROM fc GROUP BY 1, 2),
monthly AS (SELECT region, CAST(month(ds) AS INTEGER) AS month, avg(yhat) AS v FROM fc GROUP BY 1, 2),
year_ranks AS (
  SELECT *, row_number() OVER (PARTITION BY region ORDER BY v DESC, year) AS wet,
    row_number() OVER (PARTITION BY region ORDER BY v, year) AS dry,
    row_number() OVER (PARTITION BY region ORDER BY year) AS first,
    row_number() OVER (PARTITION BY region ORDER BY year DESC) AS last FROM yearly),
month_ranks AS (
  SELECT *, row_number() OVER (PARTITION BY region ORDER BY v DESC, month) AS wet,
    row_number() OVER (PARTITION BY region ORDER BY v, month) AS dry FROM monthly),
years AS (
  SELECT region, count(*) AS n, regr_slope(v, year) AS slope,
    max(year) FILTER (WHERE wet = 1) AS wettest_year, max(year) FILTER (WHERE dry = 1) AS driest_year,
    min(year) AS start_year, max(year) AS end_year,
    max(v) FILTER (WHERE first = 1) AS start_value, max(v) FILTER (WHERE last = 1) AS end_value
  FROM year_ranks GROUP BY region HAVING count(*) > 1),
months AS (
  SELECT region, max(month) FILTER (WHERE wet = 1) AS wettest_month,
    max(month) FILTER (WHERE dry = 1) AS driest_month FROM month_ranks GROUP BY region),
report AS (
  SELECT *, CASE WHEN slope > 0 THEN 'à la hausse' ELSE 'à la baisse' END AS trend_direction,
    CASE WHEN start_value > 0 THEN (end_value - start_value) / start_value * 100
      WHEN end_value > 0 THEN 'Infinity'::DOUBLE ELSE 0 END AS pct_change
  FROM years JOIN months USING (region))"""


def report_select(digits: int) -> str:
    return f"""SELECT region, trend_direction, {rd('abs(slope)', digits)} AS trend_strength, {rd('pct_change', digits)} AS pct_change,
  wettest_year, driest_year, wettest_month, driest_month, start_year, end_year,
  {rd('start_value', digits)} AS start_value, {rd('end_value', digits)} AS end_value FROM report"""


def history(spark, sf):
    return forecast.monthly_series(star.panel(spark, sf)).withColumnRenamed("y", "yhat")


@check("a14_trend_direction", f"""
WITH {HISTORY}, {REPORT} SELECT region, trend_direction, {rd('abs(slope)', 4)} AS trend_strength FROM report""")
def trend_direction(spark, sf):
    return rounded(forecast.trend_report(history(spark, sf)).select("region", "trend_direction", "trend_strength"), 4)


@check("a15_change", f"""
WITH {HISTORY}, {REPORT} SELECT region, start_year, end_year, {rd('start_value', 4)} AS start_value,
  {rd('end_value', 4)} AS end_value, {rd('pct_change', 4)} AS pct_change FROM report""")
def change(spark, sf):
    return rounded(forecast.trend_report(history(spark, sf)).select(
        "region", "start_year", "end_year", "start_value", "end_value", "pct_change"), 4)


@check("a16_extremes", f"""
WITH {HISTORY}, {REPORT} SELECT region, wettest_year, driest_year, wettest_month, driest_month FROM report""")
def extremes(spark, sf):
    return forecast.trend_report(history(spark, sf)).select(
        "region", "wettest_year", "driest_year", "wettest_month", "driest_month")


LABELS = "['Jan', 'Fév', 'Mar', 'Avr', 'Mai', 'Juin', 'Juil', 'Août', 'Sep', 'Oct', 'Nov', 'Déc']"


@check("a17_monthly_pattern", f"""
WITH {HISTORY} SELECT region, CAST(month(ds) AS INTEGER) AS month, {rd('avg(yhat)')} AS yhat,
  {LABELS}[month(ds)] AS label FROM fc GROUP BY region, month(ds)""")
def monthly_pattern(spark, sf):
    return rounded(forecast.monthly_pattern(history(spark, sf)))


def _metrics(group: str, region: str) -> str:
    return f"""SELECT {region} AS region, count(*) AS n, {rd('sqrt(avg((pred - y) * (pred - y)))')} AS rmse,
  {rd('avg(abs(pred - y))')} AS mae, {rd('1 - sum((pred - y) * (pred - y)) / (var_pop(y) * count(*))')} AS r2 FROM guessed {group}"""


@check("a18_regression_metrics", f"""
WITH {PANEL}, means AS (SELECT region, mois, avg(precipitations) AS pred FROM panel GROUP BY 1, 2),
guessed AS (SELECT p.region, precipitations AS y, pred FROM panel p JOIN means m ON p.region = m.region AND p.mois = m.mois)
{_metrics('', "'*'")} UNION ALL {_metrics('GROUP BY region', 'region')}""")
def regression_metrics(spark, sf):
    panel = star.panel(spark, sf)
    means = panel.groupBy("region", "mois").agg(F.avg("precipitations").alias("prediction"))
    guessed = panel.join(means, ["region", "mois"])
    overall = models.regression_metrics(guessed).withColumn("region", F.lit("*"))
    return rounded(overall.unionByName(models.regression_metrics(guessed, keys=["region"])))


@check("a19_split_sizes", f"""
WITH {PANEL}, sizes AS (
  SELECT count(*) FILTER (WHERE annee < 2000) AS n_train, count(*) FILTER (WHERE annee >= 2000) AS n_test FROM panel)
SELECT n_train, n_test, {rd('100.0 * n_train / (n_train + n_test)')} AS pct_train,
  {rd('100.0 * n_test / (n_train + n_test)')} AS pct_test FROM sizes""")
def split_sizes(spark, sf):
    return rounded(features.split_sizes(star.panel(spark, sf), 2000))


@check("a20_horizon_years", f"""
WITH {HISTORY} SELECT region, CAST(max(year(ds)) - min(year(ds)) AS INTEGER) AS years FROM fc GROUP BY region""")
def horizon_years(spark, sf):
    return forecast.horizon_years(history(spark, sf))


TOTALS = "totals AS (SELECT region, annee, sum(precipitations) AS total FROM panel GROUP BY 1, 2)"


@check("a21_interannual_variability", f"""
WITH {PANEL}, {TOTALS} SELECT region, count(*) AS n_years, {rd('avg(total)')} AS mean_total, {rd('stddev_samp(total)')} AS sd_total,
  {rd('stddev_samp(total) / avg(total)')} AS variability FROM totals GROUP BY region""")
def interannual_variability(spark, sf):
    return rounded(explore.interannual_variability(star.panel(spark, sf)))


@check("a22_annual_trend", f"""
WITH {PANEL}, {TOTALS} SELECT region, count(*) AS n_years, {rd('regr_slope(total, annee)')} AS slope FROM totals GROUP BY region""")
def annual_trend(spark, sf):
    return rounded(explore.annual_trend(star.panel(spark, sf)))


def _rolling(source: str) -> str:
    frames = ", ".join(
        rd(f"avg(precipitations) OVER (PARTITION BY region ORDER BY date RANGE BETWEEN INTERVAL {n - 1} DAY PRECEDING AND CURRENT ROW)")
        + f" AS mean_{n}d" for n in (7, 30))
    return f"SELECT region, date, {rd('precipitations')} AS precipitations, {frames} FROM {source}"


@check("w1_rolling_mean", f"WITH {PANEL} {_rolling('panel')}")
def rolling_mean(spark, sf):
    return rounded(windows.rolling_mean(star.panel(spark, sf)))


@check("w1_rolling_mean_dense", f"WITH {EVENTS}, {densified('event_panel', True)} {_rolling('dense')}")
def rolling_mean_dense(spark, sf):
    return rounded(windows.rolling_mean(quality.densify(star.event_panel(spark, sf))))


# One point has no slope: NULL by the SQL standard, where DuckDB gives NaN for some. Many slopes are
# exact binary fractions; the small shift keeps their rounding from hanging on the last bit.
SHIFT = 3e-8
SLOPE = """CASE WHEN count(precipitations) OVER w > 1
  THEN regr_slope(precipitations, date_diff('day', DATE '1970-01-01', date)) OVER w END"""


@check("w2_trend_indicators", f"""
WITH {PANEL} SELECT region, date, {rd('precipitations')} AS precipitations,
  {rd('precipitations - lag(precipitations) OVER (PARTITION BY region ORDER BY date)')} AS change,
  {rd(f'{SLOPE} + {SHIFT}')} AS slope_30d
FROM panel WINDOW w AS (PARTITION BY region ORDER BY date RANGE BETWEEN INTERVAL 29 DAY PRECEDING AND CURRENT ROW)""")
def trend_indicators(spark, sf):
    found = windows.trend_indicators(star.panel(spark, sf))
    return rounded(found.withColumn("slope_30d", F.col("slope_30d") + F.lit(SHIFT)))


@check("w3_allocate", f"""
WITH {PANEL} SELECT region, date, {rd('precipitations')} AS precipitations, {rd('humidite')} AS humidite,
  {rd("CASE WHEN sum(precipitations) OVER w <> 0 THEN precipitations / sum(precipitations) OVER w * humidite END")} AS allocated
FROM panel WINDOW w AS (PARTITION BY region, annee, mois)""")
def allocate(spark, sf):
    shared = windows.allocate(star.panel(spark, sf), ["region", "annee", "mois"], "precipitations", "humidite")
    return rounded(shared.select("region", "date", "precipitations", "humidite", "allocated"))


@check("w4_anomalies", f"""
WITH {PANEL}, scored AS (
  SELECT region, date, precipitations, CASE WHEN stddev_samp(precipitations) OVER w > 0
    THEN (precipitations - avg(precipitations) OVER w) / stddev_samp(precipitations) OVER w END AS z
  FROM panel WINDOW w AS (PARTITION BY region, mois))
SELECT region, date, {rd('precipitations')} AS precipitations, {rd('z')} AS z, abs(z) >= 3 AS is_anomaly FROM scored""")
def anomalies(spark, sf):
    flagged = windows.anomalies(star.panel(spark, sf))
    return rounded(flagged.select("region", "date", "precipitations", "z", "is_anomaly"))


@check("w5_ranked_extremes", f"""
WITH {PANEL}, ranked AS (
  SELECT region, date, precipitations, row_number() OVER (PARTITION BY region ORDER BY precipitations DESC, date) AS rn FROM panel)
SELECT region, date, {rd('precipitations')} AS precipitations FROM ranked WHERE rn = 1""")
def ranked_extremes(spark, sf):
    return rounded(explore.wettest_day(star.panel(spark, sf)))
