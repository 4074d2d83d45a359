"""Tree models of daily rain: training, scoring, evaluation, comparison and search."""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import partial
from itertools import product

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame, functions as F
from pyspark.storagelevel import StorageLevel

from rainpanel.functions import rain_class
from rainpanel.operators.explore import RAIN
from rainpanel.operators.features import (
    RAW_VECTOR, SCALED_VECTOR, add_calendar_features, check_categories, feature_pipeline,
    feature_stages,
)
from rainpanel.schema import MODEL_CATEGORICAL, MODEL_NUMERIC
from rainpanel.sources.tables import settled, use_checkpoint_folder

# Settings of the two models.
FOREST_SETTINGS = {"numTrees": 100, "maxDepth": 10, "seed": 42}
BOOSTING_SETTINGS = {"maxIter": 100, "maxDepth": 8, "stepSize": 0.1, "seed": 42}
#: Rounds of boosting between checkpoints; the trees since the last one travel with every task. No result depends on it.
CHECKPOINT_ROUNDS = 3
#: Training rows for each partition, at least: a level of a tree is a job, and each of its tasks unpacks all nodes so far.
PARTITION_ROWS = 8_192
#: The same for boosting, whose levels are those of one tree: every task sends a histogram of all its nodes, whatever its rows.
BOOSTING_PARTITION_ROWS = 32_768


def regressor(kind: str, **settings):
    """``"rf"`` or ``"gbt"`` with the default settings, any of them replaceable."""
    columns = {"featuresCol": SCALED_VECTOR, "labelCol": RAIN}
    if kind == "rf":
        return RandomForestRegressor(**columns, **(FOREST_SETTINGS | settings))
    if kind == "gbt":
        return GBTRegressor(**columns, **({"checkpointInterval": CHECKPOINT_ROUNDS} | BOOSTING_SETTINGS | settings))
    raise ValueError(f"unknown model kind: {kind}")


def _training_rows(df: DataFrame, category_limit: int | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """Rows with a label (and their columns ``keep``), kept while models train on them.

    With a checkpoint folder, boosting over many rounds restarts from shared storage when an
    executor is lost.
    """
    use_checkpoint_folder(df.sparkSession)
    rows = add_calendar_features(df).filter(F.col(RAIN).isNotNull())
    train = rows.select(RAIN, *MODEL_NUMERIC, *MODEL_CATEGORICAL, *keep).persist(StorageLevel.MEMORY_AND_DISK)
    check_categories(train, limit=category_limit)
    return train


def _inputs(features: PipelineModel, rows: DataFrame) -> DataFrame:
    """Labels and vectors of training rows, settled, in no more partitions than their number calls for.

    Every level of every tree reads them in a job of its own. Whatever stands behind them travels with each
    task of it, so they start from the checkpoint folder; without one they are kept by the executors.
    """
    partitions = max(1, math.ceil(rows.count() / PARTITION_ROWS))
    return settled(features.transform(rows).select(RAIN, SCALED_VECTOR).coalesce(partitions)).persist(StorageLevel.MEMORY_AND_DISK)


def _fit(kind: str, inputs: DataFrame, **settings):
    """The model alone, from labels and vectors; boosting reads them in fewer and larger partitions."""
    if kind == "gbt":
        inputs = inputs.coalesce(max(1, math.ceil(inputs.count() / BOOSTING_PARTITION_ROWS)))
    return regressor(kind, **settings).fit(inputs)


def fit_model(kind: str, train: DataFrame, category_limit: int | None = None, **settings) -> PipelineModel:
    """Fit features and model on training rows, as one pipeline that scores raw rows later.

    ``category_limit`` is that of :func:`check_categories`.
    """
    return fit_models((kind,), train, {kind: settings}, category_limit)[kind]


def fit_models(
    kinds: Sequence[str], train: DataFrame, settings: Mapping[str, Mapping] | None = None, category_limit: int | None = None,
) -> dict[str, PipelineModel]:
    """Fit several kinds on one reading: features once, and one frame of labels and vectors for all kinds.

    The kinds train side by side, as boosting is a long row of short jobs that leaves most cores free. Each
    result is a whole pipeline, the same as :func:`fit_model` gives for that kind alone.
    """
    rows = _training_rows(train, category_limit)
    try:
        features = feature_pipeline().fit(rows)
        inputs = _inputs(features, rows)
        try:
            fits = [
                inheritable_thread_target(train.sparkSession)(partial(_fit, kind, inputs, **(settings or {}).get(kind, {})))
                for kind in kinds]
            with ThreadPoolExecutor(max(1, len(fits))) as side_by_side:
                found = side_by_side.map(lambda fit: fit(), fits)
                return {kind: PipelineModel([*features.stages, model]) for kind, model in zip(kinds, found)}
        finally:
            inputs.unpersist()
    finally:
        rows.unpersist()


def score_together(fitted: Mapping[str, PipelineModel], df: DataFrame) -> DataFrame:
    """Rows with ``predicted_<kind>`` of every model of :func:`fit_models`, their shared features worked out once."""
    first = next(iter(fitted.values()))
    rows = PipelineModel(first.stages[:-1]).transform(add_calendar_features(df))
    for kind, model in fitted.items():
        rows = model.stages[-1].copy({model.stages[-1].predictionCol: f"predicted_{kind}"}).transform(rows)
    return rows.select(*df.columns, *[f"predicted_{kind}" for kind in fitted])


def metrics_together(scored: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """One metric row for each kind (``names`` gives the name to show), the rows read once."""
    unfolded = F.array(*[
        F.struct(F.lit(name).alias("model_name"), F.col(f"predicted_{kind}").alias("prediction")) for kind, name in names.items()])
    return regression_metrics(scored.select(RAIN, F.inline(unfolded)), keys=["model_name"])


def score(model: PipelineModel, df: DataFrame, output: str = "prediction") -> DataFrame:
    """Add the model's prediction to observation rows."""
    scored = model.transform(add_calendar_features(df))
    return scored.select(*df.columns, F.col("prediction").alias(output))


def regression_metrics(
    predictions: DataFrame, prediction: str = "prediction", label: str = RAIN, keys: Sequence[str] = ()
) -> DataFrame:
    """RMSE, MAE and R², over everything or per key, from one pass."""
    complete = F.col(label).isNotNull() & F.col(prediction).isNotNull()
    error = F.col(prediction) - F.col(label)
    n = F.count(F.lit(1))
    spread = F.var_pop(label) * n
    return predictions.filter(complete).groupBy(*keys).agg(
        n.alias("n"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        F.when(spread > 0, 1 - F.sum(error * error) / spread).alias("r2"),
    )


def evaluate(model: PipelineModel, test: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """Metrics (one row, with the model's name) and the scored test rows."""
    predictions = score(model, test)
    metrics = regression_metrics(predictions).select(F.lit(name).alias("model_name"), "*")
    return metrics, predictions


def compare_models(forest: PipelineModel, boosting: PipelineModel, test: DataFrame) -> DataFrame:
    """Actual and predicted rain of both models side by side, scored on the same rows without a join."""
    both = score(boosting, score(forest, test, "predicted_rf"), "predicted_gbt")
    return both.select("date", "region", RAIN, "predicted_rf", "predicted_gbt")


def comparison_bound(compared: DataFrame) -> DataFrame:
    """End of the perfect-prediction line: the largest value of the three columns, one row."""
    largest = [F.max(c) for c in (RAIN, "predicted_rf", "predicted_gbt")]
    return compared.agg(F.greatest(*largest).alias("bound"))


def comparison_metrics(compared: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Metric table, one row per model (and key): the row is unfolded, the data read once."""
    models = F.array(*[
        F.struct(F.lit(name).alias("model_name"), F.col(column).alias("prediction"))
        for name, column in (("Random Forest", "predicted_rf"), ("Gradient Boosted Trees", "predicted_gbt"))
    ])
    long = compared.select(*keys, RAIN, F.inline(models))
    return regression_metrics(long, keys=["model_name", *keys])


def predict_rain(model: PipelineModel, weather: DataFrame) -> DataFrame:
    """Amount and class predicted from the weather expected on each region and date."""
    scored = score(model, weather, "rainfall")
    return scored.select("region", "date", "rainfall", rain_class("rainfall").alias("category"))


def feature_importance(model: PipelineModel, sample: DataFrame) -> DataFrame:
    """Importance of each input column, one-hot slots summed, largest first.

    Slot names come from the column metadata of the assembled vector; no row of ``sample`` is read.
    """
    spark = sample.sparkSession
    features = PipelineModel(model.stages[:-1]).transform(add_calendar_features(sample).limit(0))
    groups = features.schema[RAW_VECTOR].metadata["ml_attr"]["attrs"]
    names = {attr["idx"]: attr["name"] for attrs in groups.values() for attr in attrs}
    weights = model.stages[-1].featureImportances.toArray()
    rows = [(names[i].split("_enc_")[0], float(w)) for i, w in enumerate(weights)]
    table = spark.createDataFrame(rows, "feature string, importance double")
    return table.groupBy("feature").agg(F.sum("importance").alias("importance")).orderBy(
        F.desc("importance"), "feature"
    )


def search_settings(
    kind: str, df: DataFrame, grid: Mapping[str, Iterable], test_years: Sequence[int], **settings
) -> DataFrame:
    """Error of each combination of settings, validated on each year with only earlier years as
    training rows: ``settings, test_year, n, rmse, mae, r2``. The rows are read once for all years."""
    spark = df.sparkSession
    combinations = [dict(zip(grid, values)) for values in product(*grid.values())]
    results = []
    rows = _training_rows(df.filter(F.col("annee") <= max(test_years)), keep=["annee"])
    try:
        for year in test_years:
            train = rows.filter(F.col("annee") < year)
            features = feature_pipeline().fit(train)
            inputs = _inputs(features, train)
            test = _inputs(features, rows.filter(F.col("annee") == year))
            try:
                for chosen in combinations:
                    model = _fit(kind, inputs, **(settings | chosen))
                    metrics = regression_metrics(model.transform(test)).first()
                    label = ", ".join(f"{name}={value}" for name, value in sorted(chosen.items()))
                    results.append((label, int(year), *metrics))
            finally:
                for frame in (inputs, test):
                    frame.unpersist()
    finally:
        rows.unpersist()
    return spark.createDataFrame(
        results, "settings string, test_year int, n bigint, rmse double, mae double, r2 double"
    )


def best_settings(search: DataFrame) -> DataFrame:
    """Mean error per combination over the validation years, best first."""
    means = search.groupBy("settings").agg(F.avg("rmse").alias("rmse"), F.avg("mae").alias("mae"))
    return means.orderBy("rmse", "settings")
