"""Monthly series of every region, forecast years ahead, with trend report and monthly pattern.

Reducing days to months is one pre-combined aggregate. From there a region is a short series (twelve
rows per year of history), so grouping by region is safe whatever the number of daily rows.

Two models share one coefficient table and are evaluated by Spark expressions:
``fit_month_means`` (straight trend plus one level per month; plain aggregates) and
``fit_seasonal_trend`` (bending trend plus yearly waves after Taylor & Letham, "Forecasting at
Scale", 2018; a ridge regression per region inside Spark tasks).
"""

from __future__ import annotations

import math
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from rainpanel.functions import file_key, month_index, month_label
from rainpanel.functions.calendar import DAYS_PER_YEAR
from rainpanel.operators.explore import monthly_mean

# Waves per year and per month.
YEARLY_ORDER = 6
MONTHLY_ORDER, MONTHLY_PERIOD = 5, 30.5

# Labels of the trend direction.
RISING, FALLING = "à la hausse", "à la baisse"


def monthly_series(df: DataFrame, region: str | None = None) -> DataFrame:
    """Mean rain per region and month, ``region, ds, y``; one region when it is named."""
    return monthly_mean(df if region is None else df.filter(F.col("region") == region))


def region_or_all(df: DataFrame, region: str | None) -> DataFrame:
    """Rows of the named region, or all rows when no row carries that name.

    Whether one does is part of the plan, a subquery; nothing runs before the result is asked for. Over
    a monthly series both uses share one aggregate of the raw rows.
    """
    if region is None:
        return df
    named = F.coalesce(F.col("region") == region, F.lit(False))
    return df.filter(named | ~df.agg(F.coalesce(F.max(named), F.lit(False))).scalar())


def future_calendar(series: DataFrame, periods: int = 120, mode: str = "month_start") -> DataFrame:
    """The ``periods`` months after each region's history: ``region, ds``.

    ``month_start`` continues the series' own dates. ``month_end`` starts with the end of the last
    observed month; its season then lags one month behind (31 July is where August is expected).
    """
    last = series.groupBy("region").agg(F.max("ds").alias("last"))
    return last.select("region", F.explode(_future_dates(F.col("last"), periods, mode)).alias("ds"))


def _future_dates(last: Column, periods: int, mode: str) -> Column:
    if periods < 1:
        raise ValueError("periods must be at least 1")
    if mode == "month_start":
        return F.transform(F.sequence(F.lit(1), F.lit(periods)), lambda i: F.add_months(last, i))
    if mode == "month_end":
        return F.transform(F.sequence(F.lit(0), F.lit(periods - 1)), lambda i: F.last_day(F.add_months(last, i)))
    raise ValueError(f"mode must be month_start or month_end, not {mode!r}")


def _dated(fitted: DataFrame, periods: int, mode: str) -> DataFrame:
    """Each fitted row once per date of its history and future, with the value observed there (``y``,
    NULL in the future): the rows carry their own series, so it is not read or joined again."""
    def marked(d: Column, y: Column, is_history: bool) -> Column:
        return F.struct(d.alias("ds"), y.alias("y"), F.lit(is_history).alias("is_history"))

    past = F.zip_with("dates", "observed", lambda d, y: marked(d, y, True))
    future = F.transform(_future_dates(F.array_max("dates"), periods, mode), lambda d: marked(d, F.lit(None).cast("double"), False))
    return fitted.select("*", F.inline(F.concat(past, future)))


# --- straight trend plus month levels -------------------------------------------------------------

def fit_month_means(series: DataFrame) -> DataFrame:
    """Common slope and mean point of each month, one row per region.

    Least squares of a straight trend and twelve month levels together: the slope comes from changes
    within each month over the years, so the season cannot tilt it. Without two years of any month
    the slope is 0 and the season repeats; a single point has a level and no deviation.
    """
    x = month_index("ds").cast("double")
    points = series.filter(F.col("y").isNotNull()).select(
        "region", "ds", "y", x.alias("x"), F.month("ds").alias("month"))
    months = points.groupBy("region", "month").agg(
        F.count(F.lit(1)).alias("n"), F.avg("x").alias("mx"), F.avg("y").alias("my"),
        F.regr_sxx("y", "x").alias("sxx"), F.regr_sxy("y", "x").alias("sxy"), F.regr_syy("y", "x").alias("syy"),
        F.collect_list(F.struct("ds", "y")).alias("points"),
    )
    slope = F.when(F.sum("sxx") > 0, F.sum("sxy") / F.sum("sxx")).otherwise(0.0)
    folded = months.groupBy("region").agg(
        F.sum("n").alias("n_points"), slope.alias("slope"), F.count(F.lit(1)).alias("n_months"),
        F.greatest(F.sum("syy") - slope * F.sum("sxy"), F.lit(0.0)).alias("squares"),
        F.collect_list(F.struct("month", "mx", "my")).alias("means"),
        F.array_sort(F.flatten(F.collect_list("points"))).alias("points"),
    )
    levels = F.transform("means", lambda m: F.struct(m["month"], F.struct(m["mx"].alias("x"), m["my"].alias("y"))))
    freedom = F.greatest(F.col("n_points") - F.col("n_months") - 1, F.lit(1))
    return folded.select(
        "region", "n_points", "slope", F.map_from_entries(levels).alias("levels"),
        F.when(F.col("n_points") > 1, F.sqrt(F.col("squares") / freedom)).alias("sigma"),
        F.col("points.ds").alias("dates"), F.col("points.y").alias("observed"),
    )


def forecast_month_means(
    fitted: DataFrame, periods: int = 120, mode: str = "month_start", level: float = 0.95, clip: bool = False,
    observed: bool = False,
) -> DataFrame:
    """Evaluate the fit over history and future; a month never observed takes the mean of the levels."""
    x, slope, levels = month_index("ds"), F.col("slope"), F.map_values("levels")

    def at(level: Column) -> Column:
        return level["y"] + slope * (x - level["x"])

    mean = F.aggregate(levels, F.lit(0.0), lambda total, level: total + at(level)) / F.size(levels)
    yhat = F.coalesce(at(F.try_element_at("levels", F.month("ds"))), mean)
    return _with_interval(_dated(fitted, periods, mode).withColumn("yhat", yhat), F.col("sigma"), level, clip, observed)


def _with_interval(df: DataFrame, deviation: Column, level: float, clip: bool, observed: bool) -> DataFrame:
    """The forecast's columns; with ``observed``, the month's own value ``y`` too."""
    half = deviation * NormalDist().inv_cdf((1 + level) / 2)
    bounds = {"yhat": F.col("yhat"), "yhat_lower": F.col("yhat") - half, "yhat_upper": F.col("yhat") + half}
    if clip:
        bounds = {name: F.greatest(value, F.lit(0.0)) for name, value in bounds.items()}
    own = ["y"] if observed else []
    return df.select("region", "ds", *[value.alias(name) for name, value in bounds.items()], "is_history", *own)


# --- bending trend plus yearly waves --------------------------------------------------------------

COEFFICIENT_SCHEMA = (
    "region string, n_points bigint, first_day double, span double, base double, slope double, "
    "bends array<double>, bend_slopes array<double>, cosine_periods array<double>, sine_periods array<double>, "
    "waves array<double>, sigma double, drift double, days array<int>, observed array<double>"
)


def wave_periods(yearly: bool = True, monthly: bool = False) -> tuple[list[float], list[float]]:
    """Lengths in days of the season's cosine waves and of its sine waves.

    With one point per month the sine of the sixth yearly wave is always near zero, so it is left out.
    """
    year = [DAYS_PER_YEAR / k for k in range(1, YEARLY_ORDER + 1)] if yearly else []
    month = [MONTHLY_PERIOD / k for k in range(1, MONTHLY_ORDER + 1)] if monthly else []
    return year + month, year[:-1] + month


def fit_seasonal_trend(
    series: DataFrame, yearly: bool = True, monthly: bool = False,
    bend_penalty: float = 5.0, wave_penalty: float = 0.01, max_bends: int = 25, bend_range: float = 0.8,
) -> DataFrame:
    """Fitted coefficients, one row per region with a monthly point, by one model for every length.

    The fewer the points, the more slope, bends and waves are held back, by a smooth rule: a short
    history is close to its level, a long one free. Bends lie at up to ``max_bends`` points of the
    first ``bend_range`` of the history. A single point has a level and no deviation. The row holds
    the lengths of its waves, so it can be evaluated without knowing how it was fitted. Copies of a
    date are averaged first, so a region never brings more rows than its calendar has.
    """
    cosine_periods, sine_periods = wave_periods(yearly, monthly)
    cosines, sines = (2 * np.pi / np.array(periods) for periods in (cosine_periods, sine_periods))

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("day")
        day, y = pdf["day"].to_numpy(float), pdf["y"].to_numpy(float)
        first, span = day[0], max(day[-1] - day[0], DAYS_PER_YEAR / 12)
        t, size = (day - first) / span, max(np.abs(y).max(), 1e-12)
        early = max(int(len(t) * bend_range), 1)
        n_bends = min(max_bends, early - 1)
        bends = t[np.linspace(0, early - 1, n_bends + 1).round().astype(int)][1:]
        waves = np.hstack([np.cos(np.outer(day, cosines)), np.sin(np.outer(day, sines))])
        x = np.column_stack([np.ones_like(t), t, np.maximum(t[:, None] - bends, 0), waves])
        held_back = (12 / len(y)) ** 3
        penalty = np.repeat(
            [1e-9, 1e-9 + held_back, bend_penalty + held_back, wave_penalty + held_back], [1, 1, n_bends, waves.shape[1]])
        gram = x.T @ x + np.diag(penalty)
        beta = np.linalg.solve(gram, x.T @ y)
        used = np.trace(np.linalg.solve(gram, x.T @ x))
        sigma = np.sqrt(np.sum((y - x @ beta) ** 2) / max(len(y) - used, 1.0)) if len(y) > 1 else None
        bend_slopes = beta[2:2 + n_bends]
        bent = n_bends and sigma is not None and sigma > 1e-9 * size
        return pd.DataFrame([{
            "region": pdf["region"].iloc[0], "n_points": len(y), "first_day": first, "span": span,
            "base": beta[0], "slope": beta[1], "bends": bends, "bend_slopes": bend_slopes,
            "cosine_periods": cosine_periods, "sine_periods": sine_periods, "waves": beta[2 + n_bends:],
            "sigma": sigma, "drift": np.sqrt(2 * n_bends) * np.abs(bend_slopes).mean() if bent else 0.0,
            "days": day.astype(int), "observed": y,
        }])

    points = series.filter(F.col("y").isNotNull() & F.col("region").isNotNull())
    days = points.groupBy("region", F.unix_date("ds").alias("day")).agg(F.avg("y").alias("y"))
    fitted = days.groupBy("region").applyInPandas(fit, COEFFICIENT_SCHEMA)
    return fitted.withColumn("dates", F.transform("days", F.date_from_unix_date)).drop("days")


def forecast_seasonal_trend(
    fitted: DataFrame, periods: int = 120, mode: str = "month_start", level: float = 0.95, clip: bool = False,
    observed: bool = False,
) -> DataFrame:
    """Evaluate saved or fresh coefficients over history and future, in Spark expressions only.

    The interval widens after the last observation: bends may go on at their past rate and size, so
    the variance of the trend grows with the cube of the distance.
    """
    day = F.unix_date("ds")
    t = (day - F.col("first_day")) / F.col("span")
    bent = F.aggregate(
        F.zip_with("bends", "bend_slopes", lambda at, change: change * F.greatest(t - at, F.lit(0.0))),
        F.lit(0.0), lambda total, part: total + part,
    )
    turns = F.concat(
        F.transform("cosine_periods", lambda p: F.cos(day * 2 * math.pi / p)),
        F.transform("sine_periods", lambda p: F.sin(day * 2 * math.pi / p)))
    season = F.aggregate(
        F.zip_with("waves", turns, lambda size, turn: size * turn), F.lit(0.0), lambda total, part: total + part)
    ahead = F.greatest(t - 1, F.lit(0.0))
    deviation = F.sqrt(F.col("sigma") ** 2 + F.col("drift") ** 2 * ahead * ahead * ahead / 3)
    return _with_interval(
        _dated(fitted, periods, mode).withColumn("yhat", F.col("base") + F.col("slope") * t + bent + season),
        deviation, level, clip, observed,
    )


def forecast(
    series: DataFrame, periods: int = 120, mode: str = "month_start", yearly: bool = True,
    monthly: bool = False, level: float = 0.95, clip: bool = False, observed: bool = False,
) -> DataFrame:
    """Forecast every region: ``region, ds, yhat, yhat_lower, yhat_upper, is_history``.

    One model serves all lengths of history. A region with a single month has a level and NULL
    bounds; one without an observed month cannot have a forecast (see ``without_months``).
    """
    return forecast_seasonal_trend(fit_seasonal_trend(series, yearly, monthly), periods, mode, level, clip, observed)


def without_months(series: DataFrame) -> DataFrame:
    """Regions of the series that hold no observed month, and so no forecast."""
    return series.groupBy("region").agg(F.count("y").alias("n_points")).filter(F.col("n_points") == 0)


# --- reports on a forecast ------------------------------------------------------------------------

def full_years(forecast_rows: DataFrame) -> DataFrame:
    """Rows of the years that hold all twelve months of a region."""
    rows = forecast_rows.withColumn("_year", F.year("ds"))
    years = rows.groupBy("region", "_year").agg(F.count_distinct(F.month("ds")).alias("_months"))
    return rows.join(years.filter(F.col("_months") == 12), ["region", "_year"], "left_semi").drop("_year")


def trend_report(forecast_rows: DataFrame, full_years_only: bool = False) -> DataFrame:
    """Trend of each region from its yearly means, wettest and driest years and months.

    Regions with a single year get no report; ties go to the earliest year or month.
    """
    rows = full_years(forecast_rows) if full_years_only else forecast_rows
    rows = rows.filter(F.col("yhat").isNotNull())
    parts = F.array(
        F.struct(F.lit("year").alias("part"), F.year("ds").alias("value")),
        F.struct(F.lit("month").alias("part"), F.month("ds").alias("value")),
    )
    means = rows.select("region", "yhat", F.inline(parts)).groupBy("region", "part", "value").agg(
        F.avg("yhat").alias("mean")
    )
    year, month = F.col("part") == "year", F.col("part") == "month"
    mean, value = F.col("mean"), F.col("value")

    def first_extreme(where: Column, key: Column) -> Column:
        return F.min(F.when(where, F.struct(key.alias("rank"), value)))["value"]

    report = means.groupBy("region").agg(
        F.count_if(year).alias("n_years"),
        F.regr_slope(F.when(year, mean), F.when(year, value.cast("double"))).alias("slope"),
        first_extreme(year, -mean).alias("wettest_year"), first_extreme(year, mean).alias("driest_year"),
        first_extreme(month, -mean).alias("wettest_month"), first_extreme(month, mean).alias("driest_month"),
        F.min(F.when(year, value)).alias("start_year"), F.max(F.when(year, value)).alias("end_year"),
        F.min(F.when(year, F.struct(value, mean)))["mean"].alias("start_value"),
        F.max(F.when(year, F.struct(value, mean)))["mean"].alias("end_value"),
    ).filter(F.col("n_years") > 1)
    start, end = F.col("start_value"), F.col("end_value")
    change = F.when(start > 0, (end - start) / start * 100).when(end > 0, F.lit(math.inf)).otherwise(0.0)
    return report.select(
        "region", F.when(F.col("slope") > 0, RISING).otherwise(FALLING).alias("trend_direction"),
        F.abs("slope").alias("trend_strength"), change.alias("pct_change"),
        "wettest_year", "driest_year", "wettest_month", "driest_month",
        "start_year", "end_year", "start_value", "end_value",
    )


def monthly_pattern(forecast_rows: DataFrame) -> DataFrame:
    """Mean forecast of each region and month of the year, with the month's label."""
    means = forecast_rows.groupBy("region", F.month("ds").alias("month")).agg(F.avg("yhat").alias("yhat"))
    return means.withColumn("label", month_label("month")).orderBy("region", "month")


def horizon_years(forecast_rows: DataFrame) -> DataFrame:
    """Years between the first and last forecast date of each region."""
    return forecast_rows.groupBy("region").agg((F.max(F.year("ds")) - F.min(F.year("ds"))).alias("years"))


def chart_rows(forecast_rows: DataFrame, series: DataFrame | None = None) -> DataFrame:
    """Forecast with the observations beside it (NULL in the future), and a file key per region.

    A forecast made with ``observed=True`` brings them along; to another one the series is joined.
    """
    if series is None:
        return forecast_rows.withColumn("file_key", file_key("region"))
    observed = series.select("region", "ds", "y")
    joined = forecast_rows.join(observed, ["region", "ds"], "left")
    return joined.withColumn("file_key", file_key("region"))
