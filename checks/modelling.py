"""Features and tree models (M), with the library's own settings. Each kind is fitted once a session and folder."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from checks.common import GAPPY, PANEL, check, rd, rounded, scratch
from checks.fitted import TEST_YEAR, fitted, fitted_together
from checks.functions import SEASON
from checks.tables import DATES, asked
from rainpanel.operators import climatology, features, models
from rainpanel.plans import jobs, star
from rainpanel.schema import MODEL_NUMERIC



def prepared(spark, sf):
    return features.add_calendar_features(star.panel(spark, sf))


TIMED = f"{PANEL}, timed AS (SELECT *, {SEASON} AS saison, CAST(dayofyear(date) AS INTEGER) AS jour_annee FROM panel)"


def index_sql(c: str) -> str:
    return (f"idx_{c} AS (SELECT {c}, CAST(row_number() OVER (ORDER BY count(*) DESC, {c}) - 1 AS DOUBLE) AS {c}_idx, "
            f"count(*) OVER () AS {c}_size FROM timed GROUP BY {c})")


INDEXED = TIMED + ", " + ", ".join(index_sql(c) for c in ("region", "type_sol", "saison"))
JOINED = "timed JOIN idx_region USING (region) JOIN idx_type_sol USING (type_sol) JOIN idx_saison USING (saison)"


@check("m1_calendar_features", f"""
WITH {TIMED} SELECT region, date, jour_annee, saison, CAST((mois - 1) // 3 + 1 AS INTEGER) AS trimestre FROM timed""")
def calendar_features(spark, sf):
    return prepared(spark, sf).select("region", "date", "jour_annee", "saison", "trimestre")


def indexed(spark, sf):
    """The panel with the index of its three categories, taken from tables."""
    scratch(spark)
    df = prepared(spark, sf)
    for column in ("region", "type_sol", "saison"):
        df = features.add_category_index(df, column, features.category_table(df.select(column), column))
    return df


@check("m2_category_index", f"WITH {INDEXED} SELECT region, date, region_idx, type_sol_idx, saison_idx FROM {JOINED}")
def category_index(spark, sf):
    return indexed(spark, sf).select("region", "date", "region_idx", "type_sol_idx", "saison_idx")


def slots(c: str) -> str:
    return (f"array_to_string(list_transform(generate_series(0, {c}_size - 1), "
            f"lambda i: CAST(CAST(i = {c}_idx AS INTEGER) AS VARCHAR)), '') AS {c}_slots")


@check("m3_one_hot", f"WITH {INDEXED} SELECT region, date, {slots('region')}, {slots('type_sol')}, {slots('saison')} FROM {JOINED}")
def one_hot(spark, sf):
    df = indexed(spark, sf)
    encoded = features.encoder().fit(df).transform(df)
    return encoded.select("region", "date", *[
        F.array_join(vector_to_array(f"{c}_enc").cast("array<int>"), "").alias(f"{c}_slots")
        for c in ("region", "type_sol", "saison")
    ])


GAPPY_TIMED = f"{GAPPY}, timed AS (SELECT *, {SEASON} AS saison FROM gappy)"


def width(where: str = "") -> str:
    """Ten numbers and one slot per label seen when fitting."""
    return ("CAST(10 + (SELECT count(DISTINCT region) + count(DISTINCT type_sol) + count(DISTINCT saison) "
            f"FROM timed {where}) AS INTEGER)")


COMPLETE = " AND ".join(f"{c} IS NOT NULL" for c in MODEL_NUMERIC if c != "jour_annee")


@check("m4_assembled_rows", f"""
WITH {GAPPY_TIMED} SELECT region, count(*) AS n, {width()} AS width FROM timed WHERE {COMPLETE} GROUP BY region""")
def assembled_rows(spark, sf):
    df = features.add_calendar_features(star.gappy_observations(spark, sf))
    model = features.feature_pipeline().fit(df)
    return model.transform(df).groupBy("region").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.size(vector_to_array("features"))).alias("width"))


@check("m4_skipped_rows", f"""
WITH {GAPPY} SELECT count(*) FILTER (WHERE {' OR '.join(f'{c} IS NULL' for c in MODEL_NUMERIC if c != 'jour_annee')}) AS skipped,
  count(*) AS n_rows FROM gappy""")
def skipped_rows(spark, sf):
    return features.skipped_rows(features.add_calendar_features(star.gappy_observations(spark, sf)))


def _scaled(c: str) -> str:
    return rd(f"CASE WHEN stddev_samp({c}) OVER () > 0 THEN ({c} - avg({c}) OVER ()) / stddev_samp({c}) OVER () ELSE 0 END") + f" AS {c}"


@check("m5_standardised", f"WITH {TIMED} SELECT region, date, {', '.join(_scaled(c) for c in MODEL_NUMERIC)} FROM timed")
def standardised(spark, sf):
    df = prepared(spark, sf)
    assembled = features.assembler(categorical=()).transform(df)
    scaled = features.scaler().fit(assembled).transform(assembled).withColumn("z", vector_to_array("scaled_features"))
    return rounded(scaled.select("region", "date", *[F.get("z", F.lit(i)).alias(c) for i, c in enumerate(MODEL_NUMERIC)]))


@check("m6_prepared_features", f"""
WITH {TIMED} SELECT region, count(*) AS n, {width('WHERE annee < 2000')} AS width FROM timed WHERE annee >= 2000 GROUP BY region""")
def prepared_features(spark, sf):
    train, test = features.split_by_year(prepared(spark, sf), TEST_YEAR)
    scaled = features.feature_pipeline().fit(train).transform(test)
    return scaled.groupBy("region").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.size(vector_to_array("scaled_features"))).alias("width"))


@check("m7_random_forest")
def random_forest(spark, sf):
    model, test = fitted("rf", spark, sf)
    return rounded(models.score(model, test).select("region", "date", "precipitations", "prediction"), 4)


@check("m8_boosted_trees")
def boosted_trees(spark, sf):
    model, test = fitted("gbt", spark, sf)
    return rounded(models.score(model, test).select("region", "date", "precipitations", "prediction"), 4)


@check("m9_evaluate")
def evaluate(spark, sf):
    model, test = fitted("rf", spark, sf)
    return rounded(models.evaluate(model, test, "Random Forest")[0], 4)


@check("m10_model_prediction")
def model_prediction(spark, sf):
    panel = star.panel(spark, sf)
    return rounded(models.predict_rain(
        fitted("gbt", spark, sf)[0], climatology.expected_weather(asked(spark, sf), climatology.weather_cells(panel))), 4)


@check("m10_model_prediction_job")
def model_prediction_job(spark, sf):
    return rounded(jobs.predict_with_model(fitted("rf", spark, sf)[0], star.panel(spark, sf), dates=DATES), 4)


@check("m11_compare_models")
def compare_models(spark, sf):
    (forest, boosting), test = fitted_together(("rf", "gbt"), spark, sf)
    return rounded(models.compare_models(forest, boosting, test), 4)


@check("m11_comparison_metrics")
def comparison_metrics(spark, sf):
    (forest, boosting), test = fitted_together(("rf", "gbt"), spark, sf)
    compared = models.compare_models(forest, boosting, test)
    bound = models.comparison_bound(compared)
    metrics = models.comparison_metrics(compared, keys=["region"])
    return rounded(metrics.withColumn("bound", bound.scalar()), 4)


@check("m12_feature_importance")
def feature_importance(spark, sf):
    model, test = fitted("rf", spark, sf)
    return rounded(models.feature_importance(model, test))


@check("m13_search_settings")
def search_settings(spark, sf):
    """Two depths at the library's own number of trees, over two validation years."""
    found = models.search_settings("rf", star.panel(spark, sf), {"maxDepth": (5, 10)}, test_years=(2000, 2001))
    return rounded(models.best_settings(found))
