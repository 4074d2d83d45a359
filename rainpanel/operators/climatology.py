"""Rain expected for any region and date, from month climatology plus a linear yearly trend.

The observations are read and shuffled once, into cells of (region, year, month). Everything else
works on those cells, whose number depends on regions and years but not on the row count:

    cells -> slices (one row per region: a map from month to statistics, at most 13 entries)
          -> predictions (one equi-join of requests with slices on region)

Month 0 stands for the whole region. The slices of all regions together are a single row and
enter as a scalar subquery.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from rainpanel.functions import at_least_zero, axis_top, fixed, rain_class, table_line
from rainpanel.operators.explore import RAIN
from rainpanel.operators.joins import date_array
from rainpanel.operators.quality import fill_defaults
from rainpanel.schema import WEATHER_COLUMNS, with_date_parts

MIN_TREND_YEARS = 3
WHOLE = 0


def rain_cells(df: DataFrame) -> DataFrame:
    """Counts, sums and squared deviations of rain per (region, year, month)."""
    n = F.count(RAIN)
    place = [
        agg.alias(f"{name}_{axis}")
        for axis in ("latitude", "longitude")
        for name, agg in _place_sums(df, axis)
    ]
    return df.filter(F.col("date").isNotNull()).groupBy(
        "region", F.year("date").alias("annee"), F.month("date").alias("mois")
    ).agg(
        F.count(F.lit(1)).alias("n_rows"), n.alias("n"), F.sum(RAIN).alias("total"),
        (F.var_pop(RAIN) * n).alias("squares"), *place,
    )


def _place_sums(df: DataFrame, axis: str) -> list[tuple[str, Column]]:
    if axis in df.columns:
        return [("n", F.count(axis)), ("sum", F.sum(axis).cast("double"))]
    return [("n", F.sum(F.lit(0))), ("sum", F.sum(F.lit(None).cast("double")))]


_SUMMED = ("n_rows", "n", "total", "n_latitude", "sum_latitude", "n_longitude", "sum_longitude")


def _pooled_squares() -> Column:
    """Squared deviations around the common mean: those within the parts plus those between them."""
    between = F.sum(F.when(F.col("n") > 0, F.col("total") * F.col("total") / F.col("n"))) \
        - F.try_divide(F.sum("total") * F.sum("total"), F.sum("n"))
    return F.sum("squares") + F.greatest(between, F.lit(0.0))


def _with_slice(cells: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Each cell once for its month and once for the whole (``slice`` 0), a region in one place.

    A region has at most twelve cells per year, so placing it whole is safe, and the groupings that
    follow need no further shuffle. Without keys, tasks combine before their few rows meet.
    """
    placed = cells.repartition(*keys) if keys else cells
    return placed.withColumn("slice", F.explode(F.array(F.col("mois"), F.lit(WHOLE))))


def _slice_rows(cells: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Statistics per key and slice."""
    by_year = _with_slice(cells, keys).groupBy(*keys, "annee", "slice").agg(
        *[F.sum(c).alias(c) for c in _SUMMED], _pooled_squares().alias("squares"),
    )
    mean = F.when(F.col("n") > 0, F.col("total") / F.col("n"))
    n, years = F.sum("n"), F.count(F.lit(1))
    slope = F.coalesce(F.regr_slope(mean, F.col("annee")), F.lit(0.0))
    return by_year.groupBy(*keys, "slice").agg(
        F.try_divide(F.sum("total"), n).alias("mean"),
        F.when(n > 1, F.sqrt(_pooled_squares() / (n - 1))).alias("std_deviation"),
        F.sum("n_rows").alias("data_points"),
        years.alias("years_of_data"),
        (F.sum(F.col("annee") * F.col("n_rows")) / F.sum("n_rows")).alias("mean_year"),
        F.when(years >= MIN_TREND_YEARS, slope).otherwise(0.0).alias("annual_trend"),
        F.try_divide(F.sum("sum_latitude"), F.sum("n_latitude")).alias("latitude"),
        F.try_divide(F.sum("sum_longitude"), F.sum("n_longitude")).alias("longitude"),
    )


_STATS = (
    "mean", "std_deviation", "data_points", "years_of_data", "mean_year", "annual_trend",
    "latitude", "longitude",
)


def _fold(rows: DataFrame, keys: Sequence[str], stats: Sequence[str]) -> DataFrame:
    """One row per key: ``slices``, a map from slice (0..12) to its statistics."""
    entry = F.when(F.col("slice").isNotNull(), F.struct("slice", F.struct(*stats)))
    return rows.groupBy(*keys).agg(F.map_from_entries(F.collect_list(entry)).alias("slices"))


def slice_statistics(cells: DataFrame) -> DataFrame:
    """Statistics of each region and month, and of each region as a whole (``mois`` 0)."""
    return _slice_rows(cells, ["region"]).withColumnRenamed("slice", "mois")


def overall_statistics(cells: DataFrame) -> DataFrame:
    """The same over all regions together."""
    return _slice_rows(cells, []).withColumnRenamed("slice", "mois")


def region_slices(cells: DataFrame) -> DataFrame:
    return _fold(_slice_rows(cells, ["region"]), ["region"], _STATS)


def overall_slices(cells: DataFrame) -> DataFrame:
    return _fold(_slice_rows(cells, []), [], _STATS)


def _look_up(requests: DataFrame, slices: DataFrame) -> DataFrame:
    """Left join on region. The null-safe match keeps Spark from adding a not-null filter below the
    slices, so they and the overall row share one reading and one shuffle of the observations."""
    keyed = slices.withColumnRenamed("region", "_region")
    return requests.join(keyed, F.col("region").eqNullSafe(F.col("_region")), "left").drop("_region")


def predict(requests: DataFrame, cells: DataFrame, unknown_regions: bool = True) -> DataFrame:
    """Prediction report for each requested region and date.

    The slice used is the region's month, else the whole region; for a region never observed the
    month over all regions, else everything. With ``unknown_regions=False`` such requests are left
    out (see ``unknown_requests`` for the list of them).
    """
    if not unknown_regions:
        return _report(requests.join(region_slices(cells), "region", "inner"))
    joined = _look_up(requests.withColumn("overall", overall_slices(cells).scalar()), region_slices(cells))
    return _report(joined.withColumn("slices", F.coalesce("slices", "overall")))


def predict_all(cells: DataFrame, dates: Iterable[dt.date]) -> DataFrame:
    """Prediction report of every observed region for each date: no request table, no join."""
    slices = region_slices(cells.filter(F.col("region").isNotNull()))
    return _report(slices.withColumn("date", F.explode(date_array(dates))))


def _report(joined: DataFrame) -> DataFrame:
    slices = F.col("slices")
    chosen = joined.select(
        "region", "date", slices[WHOLE].alias("whole"),
        F.coalesce(F.try_element_at(slices, F.month("date")), slices[WHOLE]).alias("s"),
    )
    expected = F.col("s.mean") + F.col("s.annual_trend") * (F.year("date") - F.col("s.mean_year"))
    return chosen.withColumn("precipitation", at_least_zero(expected)).select(
        "region", "date", "precipitation", "s.std_deviation",
        rain_class("precipitation").alias("category"), "s.data_points", "s.years_of_data",
        "s.annual_trend", "whole.latitude", "whole.longitude",
    )


def map_points(predictions: DataFrame) -> DataFrame:
    """Predictions that have coordinates, for a map."""
    placed = predictions.filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    return placed.select("region", "date", "latitude", "longitude", "precipitation")


def map_bounds(predictions: DataFrame, margin: float = 0.5) -> DataFrame:
    """Axis limits of the map: one row."""
    return map_points(predictions).agg(
        (F.min("longitude") - margin).alias("x_min"), (F.max("longitude") + margin).alias("x_max"),
        (F.min("latitude") - margin).alias("y_min"), (F.max("latitude") + margin).alias("y_max"),
    )


def summary_table(predictions: DataFrame) -> DataFrame:
    """Region, amount with two decimals, class, and the printable line, by region."""
    return predictions.select(
        "region", "date", fixed("precipitation").alias("mm"), "category",
        table_line("region", "precipitation", "category").alias("line"),
    ).orderBy("region", "date")


def chart_values(predictions: DataFrame) -> DataFrame:
    """Bar height, error bar and upper axis value of each prediction chart."""
    error_bar = F.when(F.col("std_deviation") > 0, F.col("std_deviation"))
    return predictions.select(
        "region", "date", "precipitation", error_bar.alias("error_bar"),
        axis_top("precipitation", "std_deviation").alias("axis_top"),
    )


def weather_cells(df: DataFrame) -> DataFrame:
    """Counts and sums of the weather columns per (region, month, soil type)."""
    sums = [agg for c in WEATHER_COLUMNS for agg in (
        F.count(c).alias(f"n_{c}"), F.sum(F.col(c).cast("double")).alias(f"sum_{c}"),
    )]
    return df.groupBy("region", "mois", "type_sol").agg(F.count(F.lit(1)).alias("n_rows"), *sums)


def _weather_rows(cells: DataFrame, keys: Sequence[str]) -> DataFrame:
    summed = ["n_rows", *[f"{part}_{c}" for c in WEATHER_COLUMNS for part in ("n", "sum")]]
    by_soil = _with_slice(cells, keys).groupBy(*keys, "slice", "type_sol").agg(
        *[F.sum(c).alias(c) for c in summed]
    )
    most = F.min(F.struct((-F.col("n_rows")).alias("rank"), "type_sol"))
    return by_soil.groupBy(*keys, "slice").agg(
        *[F.try_divide(F.sum(f"sum_{c}"), F.sum(f"n_{c}")).alias(c) for c in WEATHER_COLUMNS],
        most["type_sol"].alias("type_sol"), F.sum("n_rows").alias("n_rows"),
    )


_WEATHER = (*WEATHER_COLUMNS, "type_sol", "n_rows")


def weather_means(cells: DataFrame) -> DataFrame:
    """Mean weather and most frequent soil of each region and month (whole region: ``mois`` 0)."""
    return _weather_rows(cells, ["region"]).withColumnRenamed("slice", "mois")


def expected_weather(requests: DataFrame, cells: DataFrame) -> DataFrame:
    """Model input for each request: mean weather of the region's month, else region, else all rows."""
    overall = _fold(_weather_rows(cells, []), [], _WEATHER).select(F.col("slices")[WHOLE]).scalar()
    return _weather_input(_look_up(requests.withColumn("overall", overall), _weather_slices(cells)))


def expected_weather_all(cells: DataFrame, dates: Iterable[dt.date]) -> DataFrame:
    """Model input of every observed region for each date: no request table, no join."""
    slices = _weather_slices(cells.filter(F.col("region").isNotNull()))
    dated = slices.withColumn("date", F.explode(date_array(dates)))
    return _weather_input(dated.withColumn("overall", F.col("slices")[WHOLE]))


def _weather_slices(cells: DataFrame) -> DataFrame:
    return _fold(_weather_rows(cells, ["region"]), ["region"], _WEATHER)


def _weather_input(joined: DataFrame) -> DataFrame:
    slices = F.col("slices")
    chosen = F.coalesce(F.try_element_at(slices, F.month("date")), slices[WHOLE], F.col("overall"))
    weather = joined.select("region", "date", chosen.alias("w")).select(
        "region", "date", F.lit(0.0).alias(RAIN),
        *[F.col(f"w.{c}").alias(c) for c in (*WEATHER_COLUMNS, "type_sol")],
    )
    return fill_defaults(with_date_parts(weather))
