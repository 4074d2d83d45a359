import datetime as dt
from threading import Barrier

import numpy as np
import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from rainpanel import SCHEMA, sources
from rainpanel.operators import climatology, features, models
from rainpanel.plans import jobs

SMALL = {"rf": {"numTrees": 10, "maxDepth": 5}, "gbt": {"maxIter": 8, "maxDepth": 3}}


@pytest.fixture(scope="module")
def panel(spark):
    """Rain depends on season and region; some soils only appear in the last years."""
    rng = np.random.default_rng(1)
    rows = []
    for region, wet in (("A", 20.0), ("B", 5.0)):
        for i in range(0, 365 * 4, 3):
            date = dt.date(2018, 1, 1) + dt.timedelta(days=i)
            rain = wet * (6 <= date.month <= 10) + float(rng.uniform(0, 1))
            soil = "late" if date.year == 2021 and i % 2 else "clay"
            rows.append((region, date, date.year, date.month, date.day, rain, 20.0 + date.month, 30.0, 50.0, 10 + i % 5,
                         1010.0, 14.0, -17.0, 10, soil, 5))
    return spark.createDataFrame(rows, SCHEMA).cache()


def test_index_order_and_missing(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",), (None,)], "region string")
    model = features.indexer(["region"]).fit(df)
    assert list(model.labelsArray[0]) == ["c", "a", "b"]
    got = {r["region"]: r["region_idx"] for r in model.transform(df).collect()}
    assert got[None] == 3.0


def test_unseen_category_is_all_zero(panel):
    train, test = features.split_by_year(features.add_calendar_features(panel), 2021)
    pipeline = features.feature_pipeline().fit(train)
    late = pipeline.transform(test.filter("type_sol = 'late'")).select(vector_to_array("type_sol_enc").alias("v"))
    assert {tuple(r["v"]) for r in late.collect()} == {(0.0,)}


def test_rows_with_a_missing_input_are_skipped_and_counted(panel):
    holes = features.add_calendar_features(panel).withColumn("humidite", F.when(F.col("jour") > 3, F.col("humidite")))
    counts = features.skipped_rows(holes).first()
    assert features.feature_pipeline().fit(holes).transform(holes).count() == counts["n_rows"] - counts["skipped"]
    assert counts["skipped"] > 0


def test_scaled_inputs_have_mean_zero_and_unit_deviation(panel):
    df = features.add_calendar_features(panel)
    scaled = features.feature_pipeline().fit(df).transform(df).select(vector_to_array("scaled_features")[5].alias("z"))
    mean, sd = scaled.agg(F.avg("z"), F.stddev_samp("z")).first()
    assert (mean, sd) == (pytest.approx(0.0, abs=1e-9), pytest.approx(1.0))


def test_too_many_categories(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("region"))
    with pytest.raises(ValueError, match="too many"):
        features.check_categories(df, ["region"], limit=100)


def test_split_sizes(panel):
    got = features.split_sizes(panel, 2021).first()
    train, test = features.split_by_year(panel, 2021)
    assert (got["n_train"], got["n_test"]) == (train.count(), test.count())
    assert got["pct_train"] + got["pct_test"] == pytest.approx(100.0)
    assert features.split_sizes(panel.limit(0), 2021).first()["pct_train"] is None


def test_metrics_agree_with_spark_ml(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 2.5), (5.0, 7.0), (None, 1.0)], "precipitations double, prediction double")
    got = models.regression_metrics(df).first()
    evaluator = RegressionEvaluator(labelCol="precipitations", predictionCol="prediction")
    for name in ("rmse", "mae", "r2"):
        assert got[name] == pytest.approx(evaluator.setMetricName(name).evaluate(df.dropna()))
    assert got["n"] == 3


def test_train_save_load_score(spark, panel, tmp_path):
    trained = jobs.train(panel, test_year=2021, directory=str(tmp_path), settings=SMALL)
    metrics = {r["model_name"]: r["r2"] for r in trained.metrics.collect()}
    assert set(metrics) == {"Random Forest", "Gradient Boosted Trees"} and min(metrics.values()) > 0.7
    again = sources.load_model(spark, "gbt", str(tmp_path))
    both = models.score(again, models.score(trained.models["gbt"], panel, "a"), "b")
    assert both.filter("a <> b").count() == 0
    by_model = {r["model_name"]: r["r2"] for r in models.comparison_metrics(trained.compared).collect()}
    assert by_model == pytest.approx(metrics)
    bound = models.comparison_bound(trained.compared).first()["bound"]
    assert bound >= trained.compared.agg(F.max("precipitations")).first()[0]

    weights = {r["feature"]: r["importance"] for r in models.feature_importance(trained.models["rf"], panel).collect()}
    assert set(weights) == {*features.MODEL_NUMERIC, *features.MODEL_CATEGORICAL}
    assert sum(weights.values()) == pytest.approx(1.0)

    wet = jobs.predict_with_model(again, panel, dates=[dt.date(2023, 8, 15)])
    got = {r["region"]: r["rainfall"] for r in wet.collect()}
    assert got["A"] > got["B"] > 2
    requests = spark.createDataFrame([("new", dt.date(2023, 8, 15))], "region string, date date")
    assert models.predict_rain(again, climatology.expected_weather(requests, climatology.weather_cells(panel))).count() == 1


def test_default_settings():
    forest, boosting = models.regressor("rf"), models.regressor("gbt")
    assert (forest.getNumTrees(), forest.getMaxDepth(), forest.getSeed(), forest.getMaxBins()) == (100, 10, 42, 32)
    assert (boosting.getMaxIter(), boosting.getMaxDepth(), boosting.getStepSize(), boosting.getSeed()) == (100, 8, 0.1, 42)
    with pytest.raises(ValueError):
        models.regressor("svm")


def test_search_uses_earlier_years_only(panel):
    found = models.search_settings("rf", panel, {"maxDepth": (1, 5)}, test_years=(2020, 2021), numTrees=5)
    assert sorted((r["settings"], r["test_year"]) for r in found.collect()) == [
        ("maxDepth=1", 2020), ("maxDepth=1", 2021), ("maxDepth=5", 2020), ("maxDepth=5", 2021)]
    assert models.best_settings(found).first()["settings"] == "maxDepth=5"


def test_kinds_fitted_together_equal_each_alone(panel):
    train, test = features.split_by_year(panel, 2021)
    together = models.fit_models(("rf", "gbt"), train, SMALL)
    for kind, model in together.items():
        alone = models.score(models.fit_model(kind, train, **SMALL[kind]), models.score(model, test, "a"), "b")
        assert alone.filter("abs(a - b) > 1e-9").count() == 0
    scored = models.score_together(together, test)
    one_by_one = models.compare_models(together["rf"], together["gbt"], test)
    assert scored.select(*one_by_one.columns).exceptAll(one_by_one).isEmpty()
    metrics = models.metrics_together(scored, {"rf": "Random Forest", "gbt": "Gradient Boosted Trees"})
    for got, want in zip(sorted(metrics.collect()), sorted(models.comparison_metrics(one_by_one).collect()), strict=True):
        assert got[0] == want[0] and tuple(got)[1:] == pytest.approx(tuple(want)[1:])


def test_training_reads_its_rows_once(spark, panel, tmp_path):
    read = spark.sparkContext.accumulator(0)

    def seen(rows):
        for row in rows:
            read.add(1)
            yield row

    counted = spark.createDataFrame(panel.rdd.mapPartitions(seen), SCHEMA)
    models.fit_models(("rf", "gbt"), counted, SMALL)
    assert read.value == panel.count()


def test_few_training_rows_are_few_tasks(spark, panel):
    """Every level of every tree is a job over these partitions, started from the checkpoint folder."""
    rows = features.add_calendar_features(panel).repartition(40)
    pipeline = features.feature_pipeline().fit(rows)
    inputs = models._inputs(pipeline, rows)
    assert inputs.rdd.getNumPartitions() == 1 and inputs.count() == panel.count()
    assert "ExistingRDD" in inputs._jdf.queryExecution().explainString(inputs._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))
    many = rows.unionAll(rows).withColumn("again", F.explode(F.sequence(F.lit(1), F.lit(20))))
    assert models._inputs(pipeline, many).rdd.getNumPartitions() == -(-many.count() // models.PARTITION_ROWS) > 1
    model = models.fit_model("gbt", panel, **SMALL["gbt"]).stages[-1]
    assert model.getOrDefault("checkpointInterval") == models.CHECKPOINT_ROUNDS


def test_boosting_takes_few_tasks_beside_the_forest(spark, panel, monkeypatch):
    """A level of one tree costs a histogram for each task, so boosting has larger partitions; both kinds train at once."""
    seen, both, regressor = {}, Barrier(2), models.regressor

    class Watched:
        def __init__(self, kind, **settings):
            self.kind, self.settings = kind, settings

        def fit(self, inputs):
            seen[self.kind] = inputs.rdd.getNumPartitions(), inputs.count()
            both.wait(120)
            return regressor(self.kind, **self.settings).fit(inputs)

    rows = panel.repartition(16)
    n = rows.count()
    monkeypatch.setattr(models, "regressor", Watched)
    monkeypatch.setattr(models, "PARTITION_ROWS", -(-n // 8))
    monkeypatch.setattr(models, "BOOSTING_PARTITION_ROWS", -(-n // 2))
    fitted = models.fit_models(("rf", "gbt"), rows, SMALL)
    assert seen == {"rf": (8, n), "gbt": (2, n)}
    scored = models.score_together(fitted, panel)
    assert scored.filter("predicted_rf IS NULL OR predicted_gbt IS NULL").count() == 0 < scored.count()


def test_search_reads_its_rows_once(spark, panel):
    read = spark.sparkContext.accumulator(0)

    def seen(rows):
        for row in rows:
            read.add(1)
            yield row

    counted = spark.createDataFrame(panel.rdd.mapPartitions(seen), SCHEMA)
    found = models.search_settings("rf", counted, {"maxDepth": (1, 2)}, test_years=(2020, 2021), numTrees=3)
    assert read.value == panel.count()
    years = {r["annee"]: r["count"] for r in panel.groupBy("annee").count().collect()}
    assert {(r["test_year"], r["n"]) for r in found.collect()} == {(y, years[y]) for y in (2020, 2021)}


def test_train_with_the_long_term_kind(spark, panel, tmp_path):
    trained = jobs.train(panel, ("longterm",), 2021, str(tmp_path))
    assert trained.models == {} and trained.metrics is None
    assert {r["region"] for r in trained.long_term_metrics.collect()} == {"A", "B"}
    saved = sources.load_coefficients(spark, f"{tmp_path}/longterm")
    assert saved.count() == 2 and set(saved.columns) == set(trained.long_term.columns)
    with pytest.raises(ValueError):
        jobs.train(panel, ("svm",))


def test_category_table_holds_a_million(spark):
    many = spark.range(1_000_000).select(F.concat(F.lit("c"), F.col("id")).alias("k"))
    rows = many.unionAll(spark.createDataFrame([("c5",), ("c5",), ("c77",), (None,)], "k string"))
    table = features.category_table(rows, "k")
    assert table.count() == 1_000_000
    assert [tuple(r) for r in table.filter("position < 3").orderBy("position").collect()] == [("c5", 0), ("c77", 1), ("c0", 2)]
    assert table.agg(F.count_distinct("position"), F.max("position")).first()[:] == (1_000_000, 999_999)
    asked = spark.createDataFrame([("c5",), ("unseen",), (None,)], "k string")
    got = features.add_category_index(asked, "k", table)
    assert {r["k"]: r["k_idx"] for r in got.collect()} == {"c5": 0.0, "unseen": 1e6, None: 1e6}


def test_category_table_agrees_with_the_indexer(spark, panel):
    df = features.add_calendar_features(panel)
    fitted = features.indexer(["type_sol"]).fit(df)
    table = {r["value"]: r["position"] for r in features.category_table(df, "type_sol").collect()}
    assert table == {label: i for i, label in enumerate(fitted.labelsArray[0])}
    indexed = features.add_category_index(df, "type_sol", features.category_table(df, "type_sol"))
    encoded = features.encoder(["type_sol"]).fit(indexed).transform(indexed)
    assert {r.n for r in encoded.select(F.size(vector_to_array("type_sol_enc")).alias("n")).distinct().collect()} == {2}
