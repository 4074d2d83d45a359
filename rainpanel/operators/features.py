"""Model inputs: calendar features, category encoding, assembly and scaling as one Spark ML pipeline."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame, Window, functions as F

from rainpanel.functions import cyclic_day, cyclic_month, season
from rainpanel.schema import MODEL_CATEGORICAL, MODEL_NUMERIC
from rainpanel.sources.tables import settled, use_checkpoint_folder

RAW_VECTOR, SCALED_VECTOR = "features", "scaled_features"


def add_calendar_features(df: DataFrame) -> DataFrame:
    """Day of year, season and quarter."""
    return df.withColumns({
        "jour_annee": F.dayofyear("date"), "saison": season("mois"), "trimestre": F.quarter("date"),
    })


def add_cyclic_features(df: DataFrame) -> DataFrame:
    """Sine and cosine of the day in the year and of the month."""
    day_sin, day_cos = cyclic_day("date")
    month_sin, month_cos = cyclic_month("mois")
    return df.withColumns({
        "jour_sin": day_sin, "jour_cos": day_cos, "mois_sin": month_sin, "mois_cos": month_cos,
    })


def indexer(columns: Sequence[str] = MODEL_CATEGORICAL) -> StringIndexer:
    """Index of each category, most frequent first; unseen and missing values share one extra index."""
    return StringIndexer(
        inputCols=list(columns), outputCols=[f"{c}_idx" for c in columns], handleInvalid="keep"
    )


def encoder(columns: Sequence[str] = MODEL_CATEGORICAL) -> OneHotEncoder:
    """One slot per known category; the extra index becomes all zeros."""
    return OneHotEncoder(inputCols=[f"{c}_idx" for c in columns], outputCols=[f"{c}_enc" for c in columns])


def category_table(df: DataFrame, column: str) -> DataFrame:
    """``value, position``: the values of a column, the most frequent first, ties by name, from position 0.

    The table stays distributed: counts are put into one order by ranges, and each range starts after
    the sizes of those before it. Only the number of ranges meets in one task, so no list of labels is
    ever on the driver or in every task. The order is written once to the checkpoint folder, which
    must be known (``spark.checkpoint.dir``).
    """
    if use_checkpoint_folder(df.sparkSession) is None:
        raise ValueError("a category table needs spark.checkpoint.dir, a folder that all executors share")
    counts = df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n")).filter(F.col("value").isNotNull())
    order = (F.desc("n"), F.col("value"))
    ranged = settled(counts.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("id", F.monotonically_increasing_id()))
    # The number holds the partition in its upper bits and the row in the lower 33.
    part, row = F.shiftright("id", 33), F.col("id").bitwiseAND(F.lit((1 << 33) - 1))
    before = F.coalesce(F.sum("size").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = ranged.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("size")).select("part", before.alias("start"))
    return ranged.withColumn("part", part).join(F.broadcast(starts), "part").select("value", (F.col("start") + row).alias("position"))


def add_category_index(df: DataFrame, column: str, table: DataFrame) -> DataFrame:
    """``<column>_idx``: each row's position in the table; unseen and missing values share the next one.

    A join: Spark broadcasts the table below its threshold and otherwise sorts and merges. The column
    carries the number of its categories, so that :func:`encoder` needs no reading of its own.
    """
    n = table.count()
    names = table.select(F.col("value").alias("_value"), F.col("position").alias("_position"))
    index = F.coalesce(F.col("_position"), F.lit(n)).cast("double")
    nominal = {"ml_attr": {"type": "nominal", "num_vals": n + 1, "name": f"{column}_idx"}}
    joined = df.join(names, F.col(column) == F.col("_value"), "left")
    return joined.select(*df.columns, index.alias(f"{column}_idx", metadata=nominal))


def assembler(
    numeric: Sequence[str] = MODEL_NUMERIC, categorical: Sequence[str] = MODEL_CATEGORICAL
) -> VectorAssembler:
    """One vector per row; rows with a missing input are left out."""
    inputs = [*numeric, *[f"{c}_enc" for c in categorical]]
    return VectorAssembler(inputCols=inputs, outputCol=RAW_VECTOR, handleInvalid="skip")


def scaler() -> StandardScaler:
    return StandardScaler(inputCol=RAW_VECTOR, outputCol=SCALED_VECTOR, withMean=True, withStd=True)


def feature_stages(
    numeric: Sequence[str] = MODEL_NUMERIC, categorical: Sequence[str] = MODEL_CATEGORICAL
) -> list:
    return [indexer(categorical), encoder(categorical), assembler(numeric, categorical), scaler()]


def feature_pipeline(
    numeric: Sequence[str] = MODEL_NUMERIC, categorical: Sequence[str] = MODEL_CATEGORICAL
) -> Pipeline:
    """The whole chain, to be fitted on training rows only. Add calendar features first."""
    return Pipeline(stages=feature_stages(numeric, categorical))


def skipped_rows(df: DataFrame, columns: Sequence[str] = MODEL_NUMERIC) -> DataFrame:
    """One row: how many rows the assembler leaves out for a missing number, of how many."""
    missing = F.lit(False)
    for name in columns:
        value = F.col(name).cast("double")
        missing = missing | value.isNull() | F.isnan(value)
    return df.agg(F.count_if(missing).alias("skipped"), F.count(F.lit(1)).alias("n_rows"))


def check_categories(df: DataFrame, columns: Sequence[str] = MODEL_CATEGORICAL, limit: int | None = None) -> None:
    """Stop before fitting when a category has more distinct values than ``limit``; without one, never.

    Spark ML keeps the labels of an indexer on the driver and in every task, so a caller whose
    categories may grow without bound sets the limit that fits the driver's memory.
    """
    if limit is None:
        return
    counts = df.agg(*[F.approx_count_distinct(c).alias(c) for c in columns]).first().asDict()
    crowded = {c: n for c, n in counts.items() if n > limit}
    if crowded:
        raise ValueError(f"too many distinct values to encode one by one: {crowded} (limit {limit})")


def split_by_year(df: DataFrame, test_year: int = 2021) -> tuple[DataFrame, DataFrame]:
    """Training rows before ``test_year`` and test rows from it on."""
    year = F.col("annee")
    return df.filter(year < test_year), df.filter(year >= test_year)


def split_sizes(df: DataFrame, test_year: int = 2021) -> DataFrame:
    """Rows and percentage of each part, from one pass: one row."""
    year = F.col("annee")
    n_train, n_test = F.count_if(year < test_year), F.count_if(year >= test_year)
    sizes = df.agg(n_train.alias("n_train"), n_test.alias("n_test"))
    total = F.col("n_train") + F.col("n_test")
    return sizes.select(
        "n_train", "n_test",
        (F.try_divide("n_train", total) * 100).alias("pct_train"),
        (F.try_divide("n_test", total) * 100).alias("pct_test"),
    )
