"""Missing values, duplicates and gaps in the observation panel."""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from rainpanel.schema import DEFAULT_SOIL, NUMERIC_COLUMNS, nan_to_null

KEEP, DROP_ROWS, FILL_MEAN, FILL_CONSTANT = "keep", "drop_rows", "fill_mean", "fill_constant"


def is_missing(field_: T.StructField) -> Column:
    column = F.col(field_.name)
    if isinstance(field_.dataType, (T.DoubleType, T.FloatType)):
        return column.isNull() | F.isnan(column)
    return column.isNull()


def missing_counts(df: DataFrame) -> DataFrame:
    """One row: ``n_rows`` and the missing count of every column, from one pass."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count_if(is_missing(f)).alias(f.name) for f in df.schema],
    )


def missing_profile(df: DataFrame) -> DataFrame:
    """Missing count and share per column: ``column, n_rows, nulls, ratio``."""
    long = missing_counts(df).unpivot("n_rows", df.columns, "column", "nulls")
    share = F.when(F.col("n_rows") > 0, F.col("nulls") / F.col("n_rows")).otherwise(0.0)
    return long.select("column", "n_rows", "nulls", share.alias("ratio"))


def drop_missing(df: DataFrame, column: str) -> DataFrame:
    """Keep rows where ``column`` holds a value (neither NULL nor NaN)."""
    return df.filter(~is_missing(df.schema[column]))


def drop_any_missing(df: DataFrame) -> DataFrame:
    """Keep rows without any missing value."""
    return df.dropna()


#: Columns in one word of a pattern.
PATTERN_BITS = 62


@dataclass(frozen=True)
class MissingPatterns:
    """Rows by the set of columns they lack: for each set that occurs, how many and the sums of their numbers.

    A set is a whole number with bit ``i`` for column ``i``. Everything that cleaning decides follows
    from this table, whatever rows it then drops: counts, shares and means over any part of the rows
    that is told by what is missing.
    """

    columns: tuple[str, ...]
    sets: tuple[tuple[int, int, dict[str, float]], ...]

    def _lacks(self, columns: Iterable[str]) -> int:
        return sum(1 << self.columns.index(c) for c in set(columns))

    def rows(self, present: Sequence[str] = ()) -> int:
        """Rows that lack none of ``present``."""
        out = self._lacks(present)
        return sum(n for missing, n, _ in self.sets if not missing & out)

    def nulls(self, column: str, present: Sequence[str] = ()) -> int:
        """Of those rows, the ones without ``column``."""
        return self.rows(present) - self.rows([*present, column])

    def mean(self, column: str, present: Sequence[str] = ()) -> float | None:
        """Mean of the numbers in ``column`` over the rows that lack none of ``present``."""
        out, n = self._lacks([*present, column]), self.rows([*present, column])
        return math.fsum(sums[column] for missing, _, sums in self.sets if not missing & out) / n if n else None


def missing_patterns(df: DataFrame) -> MissingPatterns:
    """The pattern table of ``df`` from one reading: combined in each task, a row for each pattern that occurs.

    Real tables have few patterns, at most one for each set of columns that fail together, and only
    they come to the driver.
    """
    bits = [F.when(is_missing(f), F.lit(1 << i % PATTERN_BITS)).otherwise(F.lit(0)).cast("bigint")
            for i, f in enumerate(df.schema)]
    words = [sum(bits[i + 1:i + PATTERN_BITS], bits[i]).alias(f"_word{i // PATTERN_BITS}") for i in range(0, len(bits), PATTERN_BITS)]
    numbers = [c for c in NUMERIC_COLUMNS if c in df.columns]
    values = [F.when(~is_missing(df.schema[c]), F.col(c).cast("double")).alias(c) for c in numbers]
    names = [f"_word{k}" for k in range(len(words))]
    found = df.select(*words, *values).groupBy(*names).agg(
        F.count(F.lit(1)).alias("_n"), *[F.coalesce(F.sum(c), F.lit(0.0)).alias(c) for c in numbers])
    return MissingPatterns(tuple(df.columns), tuple(
        (sum(row[name] << PATTERN_BITS * k for k, name in enumerate(names)), row["_n"], {c: row[c] for c in numbers})
        for row in found.collect()))


@dataclass(frozen=True)
class CleaningPlan:
    """What to do with each column, decided from the missing shares of the uncleaned frame, and what it leaves."""

    n_rows: int
    nulls: dict[str, int]
    actions: dict[str, str]
    means: dict[str, float]
    rows_after: int
    nulls_after: dict[str, int]

    def ratio(self, column: str) -> float:
        return self.nulls[column] / self.n_rows if self.n_rows else 0.0

    def kept_rows(self) -> Column:
        return _all_present([c for c, action in self.actions.items() if action == DROP_ROWS])


def _all(conditions: Iterable[Column]) -> Column:
    whole = F.lit(True)
    for one in conditions:
        whole = whole & one
    return whole


def _all_present(columns: list[str]) -> Column:
    return _all(F.col(name).isNotNull() for name in columns)


def _decide(name: str, is_text: bool, nulls: int, ratio: float, threshold: float) -> str:
    if nulls == 0:
        return KEEP
    if name in NUMERIC_COLUMNS:
        return FILL_MEAN if ratio > threshold else DROP_ROWS
    return FILL_CONSTANT if name == "type_sol" and is_text else KEEP


def plan_cleaning(df: DataFrame, threshold: float = 0.05) -> CleaningPlan:
    """Decide how to clean ``df`` from one reading, its pattern table (:func:`missing_patterns`).

    Columns are treated in the order of ``NUMERIC_COLUMNS``. The share of missing values is that
    of the uncleaned frame; a mean is taken over the rows left by the drops of earlier columns.
    """
    patterns = missing_patterns(df)
    n_rows = patterns.rows()
    counts = {c: patterns.nulls(c) for c in df.columns}
    order = [c for c in NUMERIC_COLUMNS if c in counts] + [c for c in counts if c not in NUMERIC_COLUMNS]
    actions = {
        name: _decide(
            name, isinstance(df.schema[name].dataType, T.StringType), counts[name],
            counts[name] / n_rows if n_rows else 0.0, threshold,
        )
        for name in order
    }
    dropped, means = [], {}
    for name, action in actions.items():
        if action == DROP_ROWS:
            dropped.append(name)
        elif action == FILL_MEAN and (mean := patterns.mean(name, dropped)) is not None:
            means[name] = mean
    filled = {*means, *(c for c, action in actions.items() if action == FILL_CONSTANT)}
    after = {c: 0 if c in filled else patterns.nulls(c, dropped) for c in df.columns}
    return CleaningPlan(n_rows, counts, actions, means, patterns.rows(dropped), after)


def apply_cleaning(df: DataFrame, plan: CleaningPlan) -> DataFrame:
    """One filter and one projection; a mean filled into an integer column loses its decimals."""
    df = nan_to_null(df)
    fills = {
        name: F.coalesce(F.col(name), F.lit(mean).cast(df.schema[name].dataType))
        for name, mean in plan.means.items()
    }
    fills |= {
        name: F.coalesce(F.col(name), F.lit(DEFAULT_SOIL))
        for name, action in plan.actions.items() if action == FILL_CONSTANT
    }
    kept = df.filter(plan.kept_rows())
    return kept.withColumns(fills) if fills else kept


def clean(df: DataFrame, threshold: float = 0.05) -> DataFrame:
    """Drop rows for columns that rarely lack a value, fill the mean where more are missing."""
    return apply_cleaning(df, plan_cleaning(df, threshold))


def quality_report(df: DataFrame, threshold: float = 0.05) -> DataFrame:
    """Per column: missing before and after, share, action, and row counts before and after.

    One reading in all: what cleaning leaves follows from the pattern table too.
    """
    plan = plan_cleaning(df, threshold)
    return df.sparkSession.createDataFrame(
        [(c, plan.nulls[c], plan.nulls_after[c], plan.ratio(c), plan.actions[c], plan.n_rows, plan.rows_after) for c in df.columns],
        "column string, nulls_before bigint, nulls_after bigint, ratio double, action string, rows_before bigint, rows_after bigint")


def fill_defaults(df: DataFrame) -> DataFrame:
    """Default for every missing measure: 0 for numbers, ``Standard`` soil; integers are truncated.

    Integer columns arriving as averages are cut to whole numbers here.
    """
    integers = ("vent", "altitude", "distance_cote")
    filled = {}
    for name in NUMERIC_COLUMNS:
        if name in df.columns and name != "precipitations":
            value = F.coalesce(F.nullif(F.col(name).cast("double"), F.lit(float("nan"))), F.lit(0.0))
            filled[name] = value.cast("int") if name in integers else value
    if "type_sol" in df.columns:
        filled["type_sol"] = F.coalesce(F.col("type_sol"), F.lit(DEFAULT_SOIL))
    return df.withColumns(filled)


def deduplicate(df: DataFrame, keys: tuple[str, ...] = ("region", "date")) -> DataFrame:
    """One row per key: the smallest by the other columns, in their order, NULL first.

    Exact copies go first, by hashing whole rows: they combine inside each task, so a key with very
    many copies sends one row per task. Only keys that then still have more than one row, the
    candidates, are compared; no raw row is sorted. The three uses of the distinct rows share one
    exchange.
    """
    rest = [c for c in df.columns if c not in keys]
    different = df.distinct()
    if not rest:
        return different
    several = different.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1)
    several = several.select(*[F.col(k).alias(f"_key_{k}") for k in keys])
    same = _all([F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys])
    candidates = different.join(several, same, "left_semi")
    best = candidates.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("row"))
    chosen = best.select(*[F.col(c) if c in keys else F.col(f"row.{c}") for c in df.columns])
    return different.join(several, same, "left_anti").unionByName(chosen)


def densify(panel: DataFrame, measure: str = "precipitations", whole_months: bool = True) -> DataFrame:
    """Add the days without a record, with 0 as the measure: ``region, date, <measure>``.

    Each region runs from its own first to its own last day, widened to whole months by default. A
    recorded day keeps its value, a missing one too; a day recorded twice stops the job.

    One reading: the recorded days of a region and month become one row with a map, which fills its
    own days and those of the months without a record that follow it.
    """
    dated = panel.filter(F.col("date").isNotNull() & F.col("region").isNotNull())
    days = dated.groupBy("region", "date").agg(F.count(F.lit(1)).alias("_n"), F.any_value(measure).alias("_value"))
    clash = F.concat(F.lit("more than one row for "), F.to_json(F.struct("region", "date")))
    single = F.when(F.col("_n") == 1, F.col("date")).otherwise(F.raise_error(clash).cast("date"))
    months = days.groupBy("region", F.trunc("date", "month").alias("_month")).agg(
        F.map_from_entries(F.collect_list(F.struct(single.alias("date"), F.struct("_value")))).alias("_days"),
        F.min("date").alias("_first"), F.max("date").alias("_last"))
    in_order = Window.partitionBy("region").orderBy("_month")  # a row for each month of a region
    following, earlier = F.lead("_month").over(in_order), F.lag("_month").over(in_order)
    start = F.col("_month") if whole_months else F.when(earlier.isNull(), F.col("_first")).otherwise(F.col("_month"))
    end = F.coalesce(F.date_sub(following, 1), F.last_day("_month") if whole_months else F.col("_last"))
    spans = months.select("region", "_days", start.alias("_start"), end.alias("_end"))
    filled = spans.select("region", "_days", F.explode(F.sequence("_start", "_end")).alias("date"))
    recorded = F.try_element_at("_days", F.col("date"))
    added = F.lit(0).cast(panel.schema[measure].dataType)
    return filled.select("region", "date", F.when(recorded.isNotNull(), recorded["_value"]).otherwise(added).alias(measure))
