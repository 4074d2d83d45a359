"""Monthly series, future calendar, forecasts and their reports (L5 to L12)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from checks.common import PANEL, check, rd, rounded
from checks.exploring import LABELS, REPORT, SERIES, report_select
from rainpanel.operators import forecast
from rainpanel.plans import jobs, star


def series(spark, sf):
    return forecast.monthly_series(star.panel(spark, sf))


@check("l5_monthly_series", f"WITH {PANEL}, {SERIES} SELECT region, ds, {rd('y')} AS y FROM series")
def monthly_series(spark, sf):
    return rounded(series(spark, sf))


FUTURE = """
last_month AS (SELECT region, max(ds) AS last FROM series GROUP BY region),
future AS (SELECT region, CAST(last + to_months(i::INTEGER) AS DATE) AS ds FROM last_month, generate_series(1, 120) AS g(i))"""


@check("l6_future_calendar", f"WITH {PANEL}, {SERIES}, {FUTURE} SELECT region, ds FROM future")
def future_calendar(spark, sf):
    return forecast.future_calendar(series(spark, sf))


@check("l6_future_month_ends", f"""
WITH {PANEL}, {SERIES}, last_month AS (SELECT region, max(ds) AS last FROM series GROUP BY region)
SELECT region, last_day(CAST(last + to_months(i::INTEGER) AS DATE)) AS ds FROM last_month, generate_series(0, 119) AS g(i)""")
def future_month_ends(spark, sf):
    return forecast.future_calendar(series(spark, sf), mode="month_end")


LEVELS = """
numbered AS (SELECT region, ds, y, year(ds) * 12 + month(ds) - 1 AS x, month(ds) AS m FROM series),
centred AS (SELECT *, y - avg(y) OVER w AS dy, x - avg(x) OVER w AS dx FROM numbered WINDOW w AS (PARTITION BY region, m)),
lines AS (SELECT region, sum(dx * dy) / sum(dx * dx) AS b, count(*) AS n, count(DISTINCT m) AS k FROM centred GROUP BY region),
levels AS (SELECT region, m, avg(x) AS mx, avg(y) AS my FROM numbered GROUP BY 1, 2),
sigmas AS (
  SELECT region, sqrt(sum((y - my - b * (x - mx)) * (y - my - b * (x - mx))) / greatest(any_value(n) - any_value(k) - 1, 1)) AS sigma
  FROM numbered JOIN levels USING (region, m) JOIN lines USING (region) GROUP BY region),
points AS (SELECT region, ds, TRUE AS is_history FROM series UNION ALL SELECT region, ds, FALSE FROM future),
fc AS (
  SELECT p.region, p.ds, is_history, sigma, my + b * (year(p.ds) * 12 + month(p.ds) - 1 - mx) AS yhat
  FROM points p JOIN lines USING (region) JOIN sigmas USING (region)
    LEFT JOIN levels l ON l.region = p.region AND l.m = month(p.ds))"""
FORECAST = f"{PANEL}, {SERIES}, {FUTURE}, {LEVELS}"
Z95 = "1.959963984540054"


def month_means(spark, sf):
    return forecast.forecast_month_means(forecast.fit_month_means(series(spark, sf)))


@check("l7_seasonal_trend_forecast")
def seasonal_trend(spark, sf):
    return rounded(forecast.forecast(series(spark, sf)), 4)


@check("l7_short_series", f"""
WITH {PANEL}, {SERIES}, ranked AS (
  SELECT region, ds, row_number() OVER (PARTITION BY region ORDER BY ds) AS r,
    [1, 5, 12, 23][CAST(substr(region, 8) AS INTEGER) % 4 + 1] AS months FROM series)
SELECT region, count(*) AS n_history, 120 AS n_future, any_value(months) > 1 AS has_bounds, TRUE AS ordered
FROM ranked WHERE r <= months GROUP BY region""")
def short_series(spark, sf):
    """Regions cut to 1, 5, 12 or 23 months: every one has its history and future, and bounds in order."""
    kept = F.get(F.array(*(F.lit(n) for n in (1, 5, 12, 23))), F.substring("region", 8, 9).cast("int") % 4)
    rank = F.row_number().over(Window.partitionBy("region").orderBy("ds"))
    short = series(spark, sf).withColumn("r", rank).withColumn("months", kept).filter("r <= months").drop("r", "months")
    ordered = F.coalesce((F.col("yhat_lower") <= F.col("yhat")) & (F.col("yhat") <= F.col("yhat_upper")), F.lit(True))
    return forecast.forecast(short).groupBy("region").agg(
        F.count_if("is_history").alias("n_history"), F.count_if(~F.col("is_history")).cast("int").alias("n_future"),
        F.every(F.col("yhat_lower").isNotNull()).alias("has_bounds"), F.every(ordered & F.col("yhat").isNotNull()).alias("ordered"))


@check("l8_month_mean_forecast", f"""
WITH {FORECAST} SELECT region, ds, {rd('yhat')} AS yhat, {rd(f'yhat - {Z95} * sigma')} AS yhat_lower,
  {rd(f'yhat + {Z95} * sigma')} AS yhat_upper, is_history FROM fc""")
def month_mean_forecast(spark, sf):
    return rounded(month_means(spark, sf))


@check("l9_trend_report", f"WITH {FORECAST}, {REPORT} {report_select(6)}")
def trend_report(spark, sf):
    return rounded(forecast.trend_report(month_means(spark, sf)))


@check("l9_trend_report_full_years", f"""
WITH {FORECAST.replace('fc AS (', 'all_fc AS (')},
full_years AS (SELECT region, year(ds) AS y FROM all_fc GROUP BY 1, 2 HAVING count(DISTINCT month(ds)) = 12),
fc AS (SELECT f.* FROM all_fc f JOIN full_years g ON f.region = g.region AND year(f.ds) = g.y),
{REPORT} {report_select(6)}""")
def trend_report_full_years(spark, sf):
    return rounded(forecast.trend_report(month_means(spark, sf), full_years_only=True))


@check("l10_monthly_pattern", f"""
WITH {FORECAST} SELECT region, CAST(month(ds) AS INTEGER) AS month, {rd('avg(yhat)')} AS yhat,
  {LABELS}[month(ds)] AS label FROM fc GROUP BY region, month(ds)""")
def monthly_pattern(spark, sf):
    return rounded(forecast.monthly_pattern(month_means(spark, sf)))


@check("l11_chart_rows", f"""
WITH {FORECAST} SELECT f.region, f.ds, {rd('yhat')} AS yhat, {rd(f'yhat - {Z95} * sigma')} AS yhat_lower,
  {rd(f'yhat + {Z95} * sigma')} AS yhat_upper, is_history, {rd('y')} AS y, replace(f.region, ' ', '_') AS file_key
FROM fc f LEFT JOIN series s ON s.region = f.region AND s.ds = f.ds""")
def chart_rows(spark, sf):
    fitted = forecast.fit_month_means(series(spark, sf))
    return rounded(forecast.chart_rows(forecast.forecast_month_means(fitted, observed=True)))


@check("l12_long_term_run")
def long_term_run(spark, sf):
    return rounded(jobs.predict_long_term(star.panel(spark, sf)).report, 4)


@check("l12_hold_out", f"""
WITH {PANEL}, {SERIES.replace('series AS', 'whole AS')},
series AS (SELECT * FROM whole WHERE year(ds) < 2001), {FUTURE}, {LEVELS},
scored AS (SELECT w.region, w.y, f.yhat FROM whole w JOIN fc f ON f.region = w.region AND f.ds = w.ds AND year(w.ds) >= 2001)
SELECT region, count(*) AS n, {rd('sqrt(avg((yhat - y) * (yhat - y)))', 4)} AS rmse, {rd('avg(abs(yhat - y))', 4)} AS mae,
  CASE WHEN var_pop(y) > 0 THEN {rd('1 - sum((yhat - y) * (yhat - y)) / (var_pop(y) * count(*))', 4)} END AS r2
FROM scored GROUP BY region""")
def hold_out(spark, sf):
    """Months from 2001 on, by the month-mean model, which SQL can fit too."""
    return rounded(jobs.hold_out_long_term(star.panel(spark, sf), 2001, "months"), 4)
