"""Sources, sinks, filters, joins, sorting and sampling (S, P, J, O)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from checks.fitted import fitted
from checks.common import EVENTS, PANEL, PANEL_COLUMNS, check, panel_select, rd, rounded, scratch
from rainpanel.operators import explore, features, forecast, joins, models
from rainpanel.operators.climatology import map_points, predict, rain_cells
from rainpanel.operators.quality import drop_any_missing, drop_missing
from rainpanel.plans import star
from rainpanel import sources
from rainpanel.schema import nan_to_null

from checks.common import GAPPY

DATES = (dt.date(2002, 2, 15), dt.date(2002, 8, 15), dt.date(2003, 12, 31))
DATE_ROWS = "(VALUES (DATE '2002-02-15'), (DATE '2002-08-15'), (DATE '2003-12-31')) AS d(date)"

WHOLE_PANEL = f"WITH {PANEL} {panel_select()}"


@check("s1_csv_quoted", f"""
WITH {PANEL}, lined AS (SELECT * REPLACE (type_sol || chr(10) || 'second, line' AS type_sol) FROM panel)
{panel_select('lined')} WHERE jour <> 31""")
def csv_quoted(spark, sf):
    """Quoted header in another order, fields with line breaks, a column too many; unreadable dates are rejected."""
    path = scratch(spark)
    panel = star.panel(spark, sf).select(*PANEL_COLUMNS[::-1]).withColumn("note", F.lit("a \"note\""))
    text = panel.withColumns({
        "type_sol": F.concat("type_sol", F.lit("\nsecond, line")),
        "date": F.when(F.col("jour") == 31, "the last").otherwise(F.col("date").cast("string"))})
    text.write.option("header", True).option("quoteAll", True).option("escape", "\"").csv(path)
    good, bad = sources.split_bad_rows(sources.read_csv(spark, path, bad_rows="keep"))
    return rounded(good)


@check("s1_csv_scan", WHOLE_PANEL)
def csv_scan(spark, sf):
    path = scratch(spark)
    sources.write_csv(star.panel(spark, sf).select(*PANEL_COLUMNS), path)
    return rounded(sources.read_csv(spark, path))


@check("s1_bad_rows", f"""
WITH {PANEL} SELECT region, count(*) FILTER (WHERE mois <> 2) AS good, count(*) FILTER (WHERE mois = 2) AS rejected
FROM panel GROUP BY region""")
def bad_rows(spark, sf):
    """February's measure is no number in the file: its lines are rejected, each told apart by its region."""
    path = scratch(spark)
    panel = star.panel(spark, sf).select(*PANEL_COLUMNS)
    broken = panel.withColumn("precipitations", F.when(F.col("mois") == 2, "oops").otherwise(F.col("precipitations").cast("string")))
    sources.write_csv(broken, path)
    good, rejected = sources.split_bad_rows(sources.read_csv(spark, path, bad_rows="keep"))
    lines = rejected.groupBy(F.split("_bad_row", ",")[0].alias("region")).agg(F.count(F.lit(1)).alias("rejected"))
    return good.groupBy("region").agg(F.count(F.lit(1)).alias("good")).join(lines, "region", "left").select(
        "region", "good", F.coalesce("rejected", F.lit(0)).alias("rejected"))


@check("s2_csv_inferred", f"""
WITH {PANEL} SELECT region, count(date) AS n, sum(precipitations) AS total FROM panel GROUP BY region""")
def csv_inferred(spark, sf):
    path = scratch(spark)
    sources.write_csv(star.panel(spark, sf), path)
    return sources.read_csv_inferred(spark, path).groupBy("region").agg(
        F.count("date").alias("n"), F.sum("precipitations").alias("total")
    )


@check("s3_csv_by_name", WHOLE_PANEL)
def csv_by_name(spark, sf):
    path = scratch(spark)
    backwards = sorted(PANEL_COLUMNS, reverse=True)
    sources.write_csv(star.panel(spark, sf).select(*backwards), path)
    return rounded(sources.read_csv_by_name(spark, path))


@check("s4_parquet_by_year", WHOLE_PANEL)
def parquet_by_year(spark, sf):
    path = scratch(spark)
    sources.write_parquet(star.panel(spark, sf), path)
    return rounded(sources.read_parquet(spark, path))


@check("s5_csv_text_dates", f"""
WITH {PANEL} SELECT region, strftime(date, '%d/%m/%Y') AS date, {rd('precipitations')} AS precipitations FROM panel""")
def csv_text_dates(spark, sf):
    path = scratch(spark)
    rows = star.panel(spark, sf).select("region", "date", "precipitations")
    sources.write_csv(rows, path, date_pattern="dd/MM/yyyy")
    return spark.read.option("header", True).schema(
        "region string, date string, precipitations double"
    ).csv(path)


@check("s6_model_save", f"""
WITH {PANEL} SELECT region, count(*) AS n, 0.0::DOUBLE AS difference FROM panel WHERE annee >= 2000 GROUP BY region""")
def model_save(spark, sf):
    return _score_difference("rf", spark, sf)


def _score_difference(kind, spark, sf):
    """Largest difference of scores before saving and after loading, by region."""
    model, test = fitted(kind, spark, sf)
    path = scratch(spark)
    sources.save_model(model, kind, path)
    again = sources.load_model(spark, kind, path)
    both = models.score(again, models.score(model, test, "before"), "after")
    return both.groupBy("region").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.abs(F.col("before") - F.col("after"))).alias("difference")
    )


@check("s7_model_load", f"""
WITH {PANEL} SELECT region, count(*) AS n, 0.0::DOUBLE AS difference FROM panel WHERE annee >= 2000 GROUP BY region""")
def model_load(spark, sf):
    return _score_difference("gbt", spark, sf)


@check("s8_coefficient_table", f"""
WITH {PANEL}, months AS (SELECT DISTINCT region, date_trunc('month', date) AS ds FROM panel)
SELECT region, count(*) + 120 AS n, 0.0::DOUBLE AS difference FROM months GROUP BY region""")
def coefficient_table(spark, sf):
    """Forecasts from saved coefficients against those from fresh ones."""
    path = scratch(spark)
    fresh = forecast.fit_seasonal_trend(forecast.monthly_series(star.panel(spark, sf)), monthly=True)
    sources.save_coefficients(fresh, path)
    saved = forecast.forecast_seasonal_trend(sources.load_coefficients(spark, path))
    direct = forecast.forecast_seasonal_trend(fresh).select("region", "ds", F.col("yhat").alias("direct"))
    return saved.join(direct, ["region", "ds"]).groupBy("region").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.max(F.abs(F.col("yhat") - F.col("direct"))), 6).alias("difference"))


@check("s9_rows_to_frame", f"""
WITH {PANEL}, given AS (
  SELECT * FROM panel UNION ALL BY NAME
  SELECT 'NATION_1' AS region, DATE '2002-03-05' AS date, 2002 AS annee, 3 AS mois, 5 AS jour,
    0.0::DOUBLE AS precipitations, 1.5::DOUBLE AS temperature_min, 2.5::DOUBLE AS temperature_max,
    30.0::DOUBLE AS humidite, 4 AS vent, 1000.0::DOUBLE AS pression, 1.0::DOUBLE AS latitude,
    1.0::DOUBLE AS longitude, 1 AS altitude, 'BUILDING' AS type_sol, 1 AS distance_cote
) {panel_select('given')}""")
def rows_to_frame(spark, sf):
    row = ("NATION_1", dt.date(2002, 3, 5), 2002, 3, 5, 0.0, 1.5, 2.5, 30.0, 4, 1000.0, 1.0, 1.0, 1, "BUILDING", 1)
    panel = star.panel(spark, sf).select(*PANEL_COLUMNS)
    return rounded(explore.union_all([panel, sources.from_rows(spark, [row])]))


@check("p1_region_month_filter", f"WITH {PANEL} {panel_select()} WHERE region = 'NATION_3' AND mois = 8")
def region_month_filter(spark, sf):
    return rounded(joins.pick_region_month(star.panel(spark, sf), "NATION_3", 8))


@check("p2_region_or_all", f"""
WITH {PANEL}
SELECT 'known' AS asked, region, count(*) AS n, {rd('avg(precipitations)')} AS mean FROM panel
WHERE region = 'NATION_7' GROUP BY region
UNION ALL SELECT 'unknown', region, count(*), {rd('avg(precipitations)')} FROM panel GROUP BY region""")
def region_or_all(spark, sf):
    panel = star.panel(spark, sf)

    def summary(asked, region):
        return forecast.region_or_all(panel, region).groupBy("region").agg(
            F.count(F.lit(1)).alias("n"), F.avg("precipitations").alias("mean")
        ).select(F.lit(asked).alias("asked"), "*")

    return rounded(summary("known", "NATION_7").unionByName(summary("unknown", "ATLANTIS")))


@check("p3_time_split", f"""
WITH {PANEL}
SELECT CASE WHEN annee < 2000 THEN 'train' ELSE 'test' END AS part, region, count(*) AS n,
  min(date) AS first_date, max(date) AS last_date
FROM panel GROUP BY 1, 2""")
def time_split(spark, sf):
    train, test = features.split_by_year(star.panel(spark, sf), 2000)

    def summary(part, df):
        return df.groupBy("region").agg(
            F.count(F.lit(1)).alias("n"), F.min("date").alias("first_date"), F.max("date").alias("last_date")
        ).select(F.lit(part).alias("part"), "*")

    return summary("train", train).unionByName(summary("test", test))


@check("p4_drop_missing", f"WITH {GAPPY} {panel_select('gappy')} WHERE pression IS NOT NULL AND NOT isnan(pression)")
def drop_missing_rows(spark, sf):
    return rounded(nan_to_null(drop_missing(star.gappy_observations(spark, sf), "pression")))


@check("p5_select_rename", f"""
WITH {PANEL} SELECT date, region, {rd('precipitations')} AS actual, {rd('humidite')} AS predicted_rf FROM panel""")
def select_rename(spark, sf):
    return rounded(joins.prediction_set(star.panel(spark, sf), {"precipitations": "actual", "humidite": "predicted_rf"}))


@check("p6_region_list", f"WITH {PANEL} SELECT DISTINCT region FROM panel")
def region_list(spark, sf):
    return joins.region_list(star.panel(spark, sf))


ASKED = f"""
names AS MATERIALIZED (SELECT n_name AS region FROM nation UNION ALL SELECT r_name FROM region),
asked AS (SELECT region, date FROM names, {DATE_ROWS}),
observed AS MATERIALIZED (SELECT region, count(*) AS n FROM panel GROUP BY region)"""


def asked(spark, sf):
    """Requests for every nation (observed) and every world region (never observed)."""
    names = spark.read.parquet(f"{sf}/nation.parquet").select(F.col("n_name").alias("region")).unionByName(
        spark.read.parquet(f"{sf}/region.parquet").select(F.col("r_name").alias("region"))
    )
    return joins.requests_for(names, DATES)


@check("p6_unknown_regions", f"""
WITH {PANEL}, {ASKED}
SELECT DISTINCT region FROM asked WHERE NOT EXISTS (SELECT 1 FROM observed o WHERE o.region = asked.region)""")
def unknown_regions(spark, sf):
    return joins.unknown_requests(asked(spark, sf), star.panel(spark, sf)).select("region").distinct()


@check("p7_with_coordinates", f"""
WITH {PANEL}, {ASKED}
SELECT a.region, a.date, {rd('any_value(p.latitude)')} AS latitude, {rd('any_value(p.longitude)')} AS longitude
FROM asked a JOIN panel p USING (region) GROUP BY 1, 2""")
def with_coordinates(spark, sf):
    predicted = predict(asked(spark, sf), rain_cells(star.panel(spark, sf)), unknown_regions=False)
    return rounded(map_points(predicted).drop("precipitation"))


REPRESENTATIVES = ("NATION_0", "NATION_5", "NATION_12", "NATION_24")


@check("p8_pick_regions", f"WITH {PANEL} {panel_select()} WHERE region IN {REPRESENTATIVES}")
def pick_regions(spark, sf):
    return rounded(joins.pick_regions(star.panel(spark, sf), REPRESENTATIVES))


@check("p9_drop_any_missing", f"""
WITH {GAPPY} {panel_select('gappy')}
WHERE {' AND '.join(f'{c} IS NOT NULL' for c in PANEL_COLUMNS)}""")
def drop_any(spark, sf):
    return rounded(drop_any_missing(star.gappy_observations(spark, sf)))


@check("j1_join_predictions", f"""
WITH {PANEL} SELECT a.date, a.region, {rd('a.precipitations')} AS precipitations,
  {rd('a.humidite')} AS predicted_rf, a.type_sol, {rd('b.pression')} AS predicted_gbt
FROM panel a JOIN panel b ON a.date = b.date AND a.region = b.region""")
def join_predictions(spark, sf):
    panel = star.panel(spark, sf)
    left = panel.select("date", "region", "precipitations", F.col("humidite").alias("predicted_rf"), "type_sol")
    right = panel.select("date", "region", F.col("pression").alias("predicted_gbt"))
    return rounded(joins.join_predictions(left, right))


@check("j2_region_attributes", f"""
WITH {PANEL} SELECT p.region, p.date, {rd('p.precipitations')} AS precipitations,
  {rd('n_nationkey')} AS latitude, {rd('n_regionkey')} AS longitude, n_nationkey AS altitude, n_regionkey AS distance_cote
FROM panel p LEFT JOIN nation ON n_name = p.region""")
def region_attributes(spark, sf):
    facts = star.panel(spark, sf).select("region", "date", "precipitations")
    return rounded(joins.add_region_attributes(facts, star.region_attributes(spark, sf)))


@check("j2_regions_without_attributes", f"""
WITH event_rows AS (SELECT event_type AS region, count(*) AS n_rows FROM events GROUP BY 1)
SELECT region, n_rows FROM event_rows WHERE region NOT IN (SELECT n_name FROM nation)""")
def without_attributes(spark, sf):
    events = spark.read.parquet(f"{sf}/events.parquet").select(F.col("event_type").alias("region"))
    return joins.regions_without_attributes(events, star.region_attributes(spark, sf))


@check("j3_known_requests", f"WITH {PANEL}, {ASKED} SELECT region, date FROM asked WHERE EXISTS (SELECT 1 FROM observed o WHERE o.region = asked.region)")
def known_requests(spark, sf):
    return joins.known_requests(asked(spark, sf), star.panel(spark, sf))


@check("j3_unknown_requests", f"WITH {PANEL}, {ASKED} SELECT region, date FROM asked WHERE NOT EXISTS (SELECT 1 FROM observed o WHERE o.region = asked.region)")
def unknown_requests(spark, sf):
    return joins.unknown_requests(asked(spark, sf), star.panel(spark, sf))


@check("j4_regions_by_dates", f"WITH {PANEL} SELECT region, date FROM (SELECT DISTINCT region FROM panel), {DATE_ROWS}")
def regions_by_dates(spark, sf):
    return joins.requests_for(joins.region_list(star.panel(spark, sf)), DATES)


@check("j4_regions_by_range", f"""
WITH {PANEL} SELECT region, CAST(d AS DATE) AS date FROM (SELECT DISTINCT region FROM panel),
  generate_series(DATE '2002-01-01', DATE '2002-12-31', INTERVAL 1 DAY) AS g(d)""")
def regions_by_range(spark, sf):
    regions = joins.region_list(star.panel(spark, sf))
    return joins.requests_between(regions, dt.date(2002, 1, 1), dt.date(2002, 12, 31))


@check("o1_ordered_rank", f"""
WITH {PANEL}, means AS (SELECT region, avg(precipitations) AS m FROM panel GROUP BY 1)
SELECT region, {rd('m')} AS precipitations_moyennes FROM means ORDER BY m DESC, region""")
def ordered_rank(spark, sf):
    return rounded(explore.mean_per_region(star.panel(spark, sf)))


@check("o2_top_one", f"""
WITH {PANEL}, counts AS (SELECT type_sol, count(*) AS n FROM panel GROUP BY 1)
SELECT type_sol, n FROM counts ORDER BY n DESC, type_sol LIMIT 1""")
def top_one(spark, sf):
    return explore.most_frequent(star.panel(spark, sf), [], "type_sol")


@check("o3_sorted_summary", f"""
WITH {PANEL} SELECT region, count(*) AS n, max(date) AS last_date FROM panel GROUP BY region ORDER BY region""")
def sorted_summary(spark, sf):
    return explore.region_extent(star.panel(spark, sf))


@check("o4_preview", f"WITH {PANEL} {panel_select()} ORDER BY region, date LIMIT 5")
def preview(spark, sf):
    return rounded(explore.preview(star.panel(spark, sf)))


@check("o5_fixed_sample", f"""
WITH {PANEL} {panel_select()}
ORDER BY md5(concat_ws('|', '42', region, CAST(date AS VARCHAR))), region, date LIMIT 1000""")
def fixed_sample(spark, sf):
    return rounded(explore.fixed_sample(star.panel(spark, sf)))


@check("o6_union", f"""
WITH {PANEL}, {EVENTS} SELECT region, date, {rd('precipitations')} AS precipitations, annee, mois, jour FROM panel
UNION ALL SELECT region, date, {rd('precipitations')}, annee, mois, jour FROM event_panel""")
def union(spark, sf):
    """Two whole panels, whose columns come in different orders."""
    columns = ("region", "date", "precipitations", "annee", "mois", "jour")
    return rounded(explore.union_all([star.panel(spark, sf).select(*columns), star.event_panel(spark, sf).select(*columns[::-1])]))
