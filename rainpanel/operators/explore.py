"""Descriptive summaries of the panel. All group, combine in each task, then shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from rainpanel.functions.calendar import month_date, month_start

RAIN = "precipitations"


def describe_columns(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, mean, sample deviation and range of numeric and text columns, one row per column.

    Numbers fill ``min, max``; texts fill ``min_text, max_text``. Dates are left out.
    """
    wanted = [f for f in df.schema if columns is None or f.name in columns]
    numeric = [f.name for f in wanted if isinstance(f.dataType, T.NumericType)]
    texts = [f.name for f in wanted if isinstance(f.dataType, T.StringType)]
    if not numeric + texts:
        raise ValueError("no numeric or text column to describe")
    no_number, no_text = F.lit(None).cast("double"), F.lit(None).cast("string")
    names = ("column", "n", "mean", "sd", "min", "max", "min_text", "max_text")

    def entry(name: str, *values: Column) -> Column:
        fields = [F.lit(name), F.count(name), *values]
        return F.struct(*[value.alias(label) for label, value in zip(names, fields)])

    entries = [
        entry(c, F.avg(c).cast("double"), F.stddev_samp(c), F.min(c).cast("double"),
              F.max(c).cast("double"), no_text, no_text)
        for c in numeric
    ] + [entry(c, no_number, no_number, no_number, no_number, F.min(c), F.max(c)) for c in texts]
    return df.agg(F.array(*entries).alias("entries")).select(F.inline("entries"))


def rows_per_region(df: DataFrame) -> DataFrame:
    counts = df.groupBy("region").agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), "region")


def region_extent(df: DataFrame) -> DataFrame:
    """Rows and last day of each region, by name."""
    return df.groupBy("region").agg(F.count(F.lit(1)).alias("n"), F.max("date").alias("last_date")).orderBy("region")


def mean_per_region(df: DataFrame) -> DataFrame:
    means = df.groupBy("region").agg(F.avg(RAIN).alias("precipitations_moyennes"))
    return means.orderBy(F.desc("precipitations_moyennes"), "region")


def mean_per_month(df: DataFrame) -> DataFrame:
    return df.groupBy("mois").agg(F.avg(RAIN).alias("precipitations_moyennes")).orderBy("mois")


def monthly_mean(df: DataFrame) -> DataFrame:
    """Mean rain of each region and month of the calendar: ``region, ds, y``."""
    dated = df.filter(F.col("date").isNotNull())
    return dated.groupBy("region", month_start("date").alias("ds")).agg(F.avg(RAIN).alias("y"))


def monthly_mean_by_parts(df: DataFrame) -> DataFrame:
    """The same from the year and month columns, in calendar order within a region."""
    means = df.groupBy("region", "annee", "mois").agg(F.avg(RAIN).alias(RAIN))
    return means.withColumn("ds", month_date("annee", "mois")).orderBy("region", "annee", "mois")


def annual_totals(df: DataFrame) -> DataFrame:
    return df.groupBy("region", "annee").agg(F.sum(RAIN).alias("total"))


def mean_annual_total(df: DataFrame) -> DataFrame:
    """Rain of an average year per region: total over the region's years ÷ number of years."""
    means = annual_totals(df).groupBy("region").agg(
        F.sum("total").alias(RAIN),
        F.count(F.lit(1)).alias("n_years"),
        (F.sum("total") / F.count(F.lit(1))).alias("precipitations_annuelles"),
    )
    return means.orderBy(F.desc("precipitations_annuelles"), "region")


def month_profile(df: DataFrame) -> DataFrame:
    """One row per region, one column per month: rain of that month in an average year."""
    cells = df.groupBy("region", "annee", "mois").agg(F.sum(RAIN).alias("total"))
    years = F.count_distinct("annee")
    return cells.groupBy("region").agg(
        *[(F.sum(F.when(F.col("mois") == m, F.col("total"))) / years).alias(f"m{m}") for m in range(1, 13)]
    )


def interannual_variability(df: DataFrame) -> DataFrame:
    """Mean, deviation and coefficient of variation of annual totals per region."""
    stats = annual_totals(df).groupBy("region").agg(
        F.count(F.lit(1)).alias("n_years"), F.avg("total").alias("mean_total"),
        F.stddev_samp("total").alias("sd_total"),
    )
    ratio = F.when(F.col("mean_total") != 0, F.col("sd_total") / F.col("mean_total"))
    return stats.withColumn("variability", ratio)


def annual_trend(df: DataFrame) -> DataFrame:
    """Least-squares slope of annual totals per region, in mm per year."""
    return annual_totals(df).groupBy("region").agg(
        F.count(F.lit(1)).alias("n_years"), F.regr_slope("total", "annee").alias("slope"),
    )


def preview(df: DataFrame, order: Sequence[str] = ("region", "date"), n: int = 5) -> DataFrame:
    """First ``n`` rows of a total order: each task keeps its own first ``n``, no full sort."""
    return df.orderBy(*order).limit(n)


def fixed_sample(
    df: DataFrame, n: int = 1000, seed: int = 42, keys: Sequence[str] = ("region", "date")
) -> DataFrame:
    """Exactly ``n`` rows (all when there are fewer), the same ones on every run and layout.

    Rows are ranked by a hash of seed and key; each task keeps its ``n`` smallest.
    """
    parts = [F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]]
    rank = F.md5(F.concat_ws("|", *parts))
    return df.orderBy(rank, *keys).limit(n)


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Stack frames by column name."""
    first, *others = frames
    for frame in others:
        first = first.unionByName(frame)
    return first


def most_frequent(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """Most frequent value of ``column`` per key; on a tie the smallest value, NULL first."""
    counts = df.groupBy(*keys, column).agg(F.count(F.lit(1)).alias("n"))
    best = counts.groupBy(*keys).agg(F.min(F.struct((-F.col("n")).alias("rank"), F.col(column))).alias("best"))
    return best.select(*keys, F.col(f"best.{column}").alias(column), (-F.col("best.rank")).alias("n"))


def wettest_day(df: DataFrame) -> DataFrame:
    """Day with most rain per region, the earliest on a tie.

    First the earliest day of each amount, by hashing; the amounts of a region, which a gauge reads in
    steps, are far fewer than its days.
    """
    amounts = df.groupBy("region", RAIN).agg(F.min("date").alias("date"))
    key = F.struct((-F.col(RAIN)).alias("rank"), F.col("date"), F.col(RAIN))
    best = amounts.groupBy("region").agg(F.min(F.when(F.col(RAIN).isNotNull(), key)).alias("best"))
    return best.select("region", "best.date", f"best.{RAIN}")
