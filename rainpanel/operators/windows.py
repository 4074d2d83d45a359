"""Rolling means, trend indicators, shares and anomalies.

Rolling operators first reduce the input to one row per region and day, so a window never holds
more rows than a region has days, however many copies of a day the input carries. A region's calendar is
cut into blocks, each a key of its own that also gets the days before it which its first days look back
to (the halo), so a long history is spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from rainpanel.operators.explore import RAIN
from rainpanel.sources.tables import measured

#: Days of a block: four years.
BLOCK_DAYS = 1461


def _daily(df: DataFrame, measure: str) -> DataFrame:
    dated = df.filter(F.col("date").isNotNull())
    return dated.groupBy("region", "date").agg(
        F.sum(measure).alias("_sum"), F.count(measure).alias("_n"),
    ).withColumn("_day", F.unix_date("date"))


def _in_blocks(daily: DataFrame, look_back: int, block_days: int, previous: bool = False) -> DataFrame:
    """Each day in its own block, and in the next one as halo (``_halo``) if that looks back to it.

    A block is longer than what is looked back to, so one halo is enough. With ``previous``, the last
    recorded day before a block is in its halo too, however long ago; those days are found from one row
    for each block.
    """
    size = max(block_days, look_back + 1)
    own = F.floor(F.col("_day") / size).cast("int")
    days = daily.withColumn("_own", own)
    after = [F.when((F.col("_own") + 1) * size - F.col("_day") <= look_back, F.col("_own") + 1)]
    if previous:
        blocks = days.groupBy("region", "_own").agg(F.max("_day").alias("_last"))
        following = F.lead("_own").over(Window.partitionBy("region").orderBy("_own"))
        ends = blocks.select(F.col("region").alias("_region"), F.col("_last"), following.alias("_following"))
        days = days.join(ends, F.col("region").eqNullSafe(F.col("_region")) & (F.col("_day") == F.col("_last")), "left")
        after.append(F.col("_following"))
    blocks = F.array_distinct(F.array_compact(F.array(F.col("_own"), *after)))
    return days.select(*daily.columns, "_own", F.explode(blocks).alias("_block")).withColumn("_halo", F.col("_own") != F.col("_block"))


def _by_block():
    return Window.partitionBy("region", "_block").orderBy("_day")


def rolling_mean(df: DataFrame, days: Sequence[int] = (7, 30), measure: str = RAIN, block_days: int = BLOCK_DAYS) -> DataFrame:
    """Mean over the last ``n`` calendar days, the current one included, for each length asked."""
    daily = _in_blocks(_daily(df, measure), max(days) - 1, block_days)
    means = []
    for n in days:
        frame = _by_block().rangeBetween(-(n - 1), 0)
        count = F.sum("_n").over(frame)
        means.append(F.when(count > 0, F.sum("_sum").over(frame) / count).alias(f"mean_{n}d"))
    found = daily.select("region", "date", "_halo", _day_mean().alias(measure), *means)
    return found.filter(~F.col("_halo")).drop("_halo")


def _day_mean():
    return F.when(F.col("_n") > 0, F.col("_sum") / F.col("_n"))


def trend_indicators(df: DataFrame, days: int = 30, measure: str = RAIN, block_days: int = BLOCK_DAYS) -> DataFrame:
    """Change since the previous recorded day and slope (per day) over the last ``days`` days."""
    daily = _in_blocks(_daily(df, measure), days - 1, block_days, previous=True).withColumn("_value", _day_mean())
    frame = _by_block().rangeBetween(-(days - 1), 0)
    found = daily.select(
        "region", "date", "_halo", F.col("_value").alias(measure),
        (F.col("_value") - F.lag("_value", 1).over(_by_block())).alias("change"),
        F.regr_slope("_value", "_day").over(frame).alias(f"slope_{days}d"),
    )
    return found.filter(~F.col("_halo")).drop("_halo")


def allocate(df: DataFrame, keys: Sequence[str], weight: str, total: str) -> DataFrame:
    """Split each group's total over its rows in proportion to their weights (``allocated``).

    Group sums are combined in each task and joined back, so a very large group stays spread out.
    """
    shared = _with_statistics(df, keys, {"_weights": F.sum(weight)})
    share = F.when(F.col("_weights") != 0, F.col(weight) / F.col("_weights"))
    return shared.select(*df.columns, (share * F.col(total)).alias("allocated"))


def anomalies(
    df: DataFrame, keys: Sequence[str] = ("region", "mois"), measure: str = RAIN, limit: float = 3.0
) -> DataFrame:
    """z-score of each row against its region and month; ``is_anomaly`` when |z| reaches ``limit``.

    z is NULL where the row has no measure or its group no spread, and ``is_anomaly`` is then false.
    """
    joined = _with_statistics(df, keys, {"_mean": F.avg(measure), "_sd": F.stddev_samp(measure)})
    z = F.when(F.col("_sd") > 0, (F.col(measure) - F.col("_mean")) / F.col("_sd"))
    return joined.select(*df.columns, z.alias("z")).withColumn(
        "is_anomaly", F.coalesce(F.abs("z") >= limit, F.lit(False)))


def _with_statistics(df: DataFrame, keys: Sequence[str], statistics: dict[str, Column]) -> DataFrame:
    """Rows with the statistics of their group, which are worked out and measured first.

    Below the session's broadcast threshold they go to every task and no row moves; above it, both
    sides are sorted by key.
    """
    groups = df.groupBy(*keys).agg(*[value.alias(name) for name, value in statistics.items()])
    groups = groups.select(*[F.col(k).alias(f"_{k}") for k in keys], *statistics)
    return df.join(measured(groups), _same(keys), "left")


def _same(keys: Sequence[str]):
    condition = F.lit(True)
    for key in keys:
        condition = condition & F.col(key).eqNullSafe(F.col(f"_{key}"))
    return condition
