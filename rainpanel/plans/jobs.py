"""Whole jobs: process, train, predict with a model, predict from climatology, forecast long term."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from rainpanel.functions import month_index
from rainpanel.operators import climatology, forecast, joins, models
from rainpanel.operators.features import split_by_year
from rainpanel.operators.quality import clean
from rainpanel.sources import read_csv, save_coefficients, save_model, settled, write_csv


def process(spark: SparkSession, source: str, target: str, threshold: float = 0.05) -> None:
    """Read a CSV, clean it, write a CSV folder."""
    write_csv(clean(read_csv(spark, source), threshold), target)


#: Kind and folder of the monthly forecast.
LONG_TERM = "longterm"


@dataclass(frozen=True)
class Training:
    """Fitted models by kind, one metric row per model, and both models' predictions when both ran.

    ``long_term`` and ``long_term_metrics`` are the forecast's coefficients and its errors by region,
    where that kind was asked for.
    """

    models: dict[str, PipelineModel]
    metrics: DataFrame | None
    compared: DataFrame | None
    long_term: DataFrame | None = None
    long_term_metrics: DataFrame | None = None


def train(
    df: DataFrame, kinds: Sequence[str] = ("rf", "gbt"), test_year: int = 2021,
    directory: str | None = None, settings: dict[str, dict] | None = None,
) -> Training:
    """Clean, split by year, fit all kinds on the early years, evaluate on the later ones, save.

    ``kinds``: ``"rf"`` and ``"gbt"``, which share features, training frame and scored test rows, and
    ``"longterm"``, the monthly forecast: it is judged on the months from ``test_year`` on, then fitted
    on all of them, and its coefficients are saved beside the models.
    """
    names = {"rf": "Random Forest", "gbt": "Gradient Boosted Trees"}
    unknown = set(kinds) - {*names, LONG_TERM}
    if unknown or not kinds:
        raise ValueError(f"kinds must be some of rf, gbt and {LONG_TERM}, not {sorted(unknown)}")
    cleaned = clean(df)
    trees = [kind for kind in kinds if kind != LONG_TERM]
    fitted, metrics, compared = {}, None, None
    if trees:
        train_rows, test_rows = split_by_year(cleaned, test_year)
        fitted = models.fit_models(trees, train_rows, settings)
        for kind, model in fitted.items():
            if directory is not None:
                save_model(model, kind, directory)
        scored = models.score_together(fitted, test_rows)
        metrics = models.metrics_together(scored, {kind: names[kind] for kind in trees})
        if {"rf", "gbt"} <= fitted.keys():
            compared = scored.select("date", "region", models.RAIN, "predicted_rf", "predicted_gbt")
    if LONG_TERM not in kinds:
        return Training(fitted, metrics, compared)
    coefficients = settled(forecast.fit_seasonal_trend(forecast.monthly_series(cleaned)))
    if directory is not None:
        save_coefficients(coefficients, f"{directory.rstrip('/')}/{LONG_TERM}")
    return Training(fitted, metrics, compared, coefficients, hold_out_long_term(cleaned, test_year))


def target_dates(
    dates: Iterable[dt.date | str] | None, days: int = 1, today: dt.date | None = None
) -> list[dt.date]:
    """The dates given, else the single day ``days`` after today.

    A date may be ISO text; text that is not a date stands for that same day.
    """
    later = (today or dt.date.today()) + dt.timedelta(days=days)
    return [later] if dates is None else [_as_date(date, later) for date in dates]


def _as_date(date: dt.date | str, default: dt.date) -> dt.date:
    if not isinstance(date, str):
        return date
    try:
        return dt.datetime.strptime(date, "%Y-%m-%d").date()
    except ValueError:
        return default


def _observed(df: DataFrame, region: str | None) -> DataFrame:
    """Rows of the region asked for (the filter reaches the scan), or all rows."""
    return df if region is None else joins.pick_region_month(df, region)


def _answered(predicted: DataFrame, region: str | None) -> DataFrame:
    """The prediction, failing when the region asked for has none: a check inside its plan."""
    if region is None:
        return predicted
    fail = F.raise_error(F.lit(f"no observation for region {region!r}")).cast("boolean")
    some = predicted.agg(F.count(F.lit(1))).scalar() > 0
    # A row that asks for the failure stands beside the prediction, which would otherwise be empty and so never look.
    ask = predicted.sparkSession.range(1).filter(F.when(some, F.lit(False)).otherwise(fail))
    return predicted.unionByName(ask.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in predicted.schema]))


def predict_with_model(
    model: PipelineModel, df: DataFrame, region: str | None = None,
    dates: Iterable[dt.date | str] | None = None, days: int = 1, today: dt.date | None = None,
) -> DataFrame:
    """Model prediction for one region or all, from the mean weather of the observations."""
    cells = climatology.weather_cells(_observed(df, region))
    weather = climatology.expected_weather_all(cells, target_dates(dates, days, today))
    return _answered(models.predict_rain(model, weather), region)


def predict_from_climatology(
    df: DataFrame, region: str | None = None, dates: Iterable[dt.date | str] | None = None,
    days: int = 1, today: dt.date | None = None,
) -> DataFrame:
    """Climatology report for one region or all; the result fails for a region never observed."""
    cells = climatology.rain_cells(_observed(df, region))
    return _answered(climatology.predict_all(cells, target_dates(dates, days, today)), region)


@dataclass(frozen=True)
class LongTerm:
    """Monthly series, forecast, trend report and monthly pattern, all regions in each frame.

    ``rejects`` names the regions left out for want of an observed month, and the region asked for
    where no row carries its name.
    """

    series: DataFrame
    forecast: DataFrame
    report: DataFrame
    pattern: DataFrame
    rejects: DataFrame


def predict_long_term(df: DataFrame, region: str | None = None, years: int = 10, **options) -> LongTerm:
    """Forecast one region, or all when none is named or the name is unknown.

    The monthly series is settled first: the daily rows are read once for all results, the choice of
    the region included.
    """
    whole = settled(forecast.monthly_series(df))
    series = forecast.region_or_all(whole, region)
    rows = forecast.forecast(series, periods=years * 12, **options)
    rejects = forecast.without_months(series)
    if region is not None:
        asked = whole.agg(F.lit(region).alias("region"), F.count_if(F.col("region") == region).alias("n_points"))
        unknown = asked.filter(F.col("n_points") == 0)
        rejects = rejects.unionByName(unknown.join(rejects.select("region"), "region", "left_anti"))
    return LongTerm(series, rows, forecast.trend_report(rows), forecast.monthly_pattern(rows), rejects)


def hold_out_long_term(df: DataFrame, test_year: int = 2021, model: str = "waves") -> DataFrame:
    """RMSE, MAE and R² of the monthly forecast in each region, on months it has not seen.

    The model, ``"waves"`` (bending trend and yearly waves) or ``"months"`` (trend and month means),
    is fitted on the months before ``test_year`` and scored on the observed ones from then on.
    Regions without months on both sides have no row.
    """
    series = settled(forecast.monthly_series(df))
    early, late = series.filter(F.year("ds") < test_year), series.filter(F.year("ds") >= test_year)
    index = month_index("ds")
    last = early.groupBy("region").agg(F.max(index).alias("last")).agg(F.min("last")).first()[0]
    end = late.agg(F.max(index)).first()[0]
    periods = max(end - last, 1) if end is not None and last is not None else 1
    if model == "waves":
        rows = forecast.forecast_seasonal_trend(forecast.fit_seasonal_trend(early), periods)
    elif model == "months":
        rows = forecast.forecast_month_means(forecast.fit_month_means(early), periods)
    else:
        raise ValueError(f"model must be waves or months, not {model!r}")
    both = rows.filter(~F.col("is_history")).select("region", "ds", "yhat").join(late, ["region", "ds"])
    return models.regression_metrics(both, "yhat", "y", ["region"])
