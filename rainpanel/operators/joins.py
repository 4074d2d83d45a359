"""Joins between observations, regions, requests and predictions.

No broadcast is forced anywhere: Spark broadcasts a side only below
``spark.sql.autoBroadcastJoinThreshold`` (checked again on real sizes while running) and otherwise
sort-merge joins it, splitting skewed partitions.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T


FIXED_WIDTH = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType)


def unique_on(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The same rows, failing the job when a key occurs twice, so a join cannot multiply rows.

    Where the other columns have a fixed width, the check is a pre-combined hash aggregate on the join
    key, and the join after it needs no new shuffle. Text would make Spark sort all rows for that, so
    with text the keys alone are counted beside the rows, as a scalar subquery.
    """
    rest = [c for c in df.columns if c not in keys]
    if any(not isinstance(df.schema[c].dataType, FIXED_WIDTH) for c in rest):
        twice = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1)
        found = twice.agg(F.min(F.to_json(F.struct(*keys)))).scalar()
        fail = F.raise_error(F.concat(F.lit("more than one row for "), found)).cast("boolean")
        return df.filter(F.when(found.isNull(), F.lit(True)).otherwise(fail))
    grouped = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), *[F.any_value(c).alias(c) for c in rest]
    )
    clash = F.concat(F.lit("more than one row for "), F.to_json(F.struct(*keys)))
    checked = F.when(F.col("_n") == 1, F.col("_n")).otherwise(F.raise_error(clash).cast("bigint"))
    return grouped.filter(checked == 1).select(*df.columns)


def prediction_set(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Date, region and the columns named, under new names: one side of :func:`join_predictions`."""
    return df.select("date", "region", *[F.col(old).alias(new) for old, new in columns.items()])


def join_predictions(
    left: DataFrame, right: DataFrame, on: Sequence[str] = ("date", "region")
) -> DataFrame:
    """Inner join of two prediction sets that hold each (date, region) once."""
    return unique_on(left, on).join(unique_on(right, on), list(on), "inner")


def add_region_attributes(facts: DataFrame, regions: DataFrame) -> DataFrame:
    """Left join of region attributes; a region without attributes keeps its rows with NULLs."""
    return facts.join(unique_on(regions, ["region"]), "region", "left")


def regions_without_attributes(facts: DataFrame, regions: DataFrame) -> DataFrame:
    """Regions of ``facts`` absent from ``regions``, with their row count."""
    counts = facts.groupBy("region").agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.join(regions.select("region"), "region", "left_anti")


def region_list(df: DataFrame) -> DataFrame:
    """Distinct region names in alphabetical order."""
    return df.select("region").filter(F.col("region").isNotNull()).distinct().orderBy("region")


def known_requests(requests: DataFrame, observed: DataFrame) -> DataFrame:
    """Requests for a region that has observations."""
    return requests.join(observed.select("region").distinct(), "region", "left_semi")


def unknown_requests(requests: DataFrame, observed: DataFrame) -> DataFrame:
    """Requests for a region without any observation."""
    return requests.join(observed.select("region").distinct(), "region", "left_anti")


def pick_regions(df: DataFrame, regions: Iterable[str]) -> DataFrame:
    return df.filter(F.col("region").isin(*regions))


def pick_region_month(df: DataFrame, region: str | None = None, month: int | None = None) -> DataFrame:
    """Rows of one region and/or one month; with a parquet source both reach the scan."""
    if region is not None:
        df = df.filter(F.col("region") == region)
    return df if month is None else df.filter(F.col("mois") == month)


def date_array(dates: Iterable[dt.date]) -> Column:
    return F.array(*[F.lit(day) for day in sorted(set(dates))]).cast(T.ArrayType(T.DateType()))


def requests_for(regions: DataFrame, dates: Iterable[dt.date]) -> DataFrame:
    """Every region with every target date: each region row carries the dates and unfolds them."""
    return regions.select("region", F.explode(date_array(dates)).alias("date"))


def requests_between(regions: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    """Every region with every day from ``first`` to ``last``."""
    days = F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))
    return regions.select("region", F.explode(days).alias("date"))
