"""Plans: what reaches the scan, what is read once, and what must never appear."""

import os
import re

import pytest
from pyspark.sql import functions as F

from checks.registry import QUERIES
from rainpanel import sources
from rainpanel.operators import climatology, explore, forecast, joins, quality, windows
from rainpanel.plans import jobs, star

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")

ML = re.compile(r"^(m\d|s6|s7)")
NEVER = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython")


def plan_of(df):
    return df._jdf.queryExecution().toString()


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not ML.match(n)))
def test_no_pair_products_and_no_python_rows(spark, name):
    plan = plan_of(QUERIES[name](spark, FOLDER))
    assert not [word for word in NEVER if word in plan]


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("panel") / "p")
    sources.write_parquet(star.panel(spark, FOLDER), path)
    return path


def test_filters_and_columns_reach_the_scan(spark, stored):
    panel = sources.read_parquet(spark, stored)
    plan = plan_of(explore.mean_per_month(joins.pick_region_month(panel, "NATION_3", 8)))
    assert "EqualTo(region,NATION_3)" in plan and "EqualTo(mois,8)" in plan
    read = re.search(r"ReadSchema: struct<(.*?)>", plan).group(1)
    assert set(read.split(",")) == {"region:string", "mois:int", "precipitations:double"}


def test_year_filter_prunes_folders(spark, stored):
    plan = plan_of(explore.mean_per_region(sources.read_parquet(spark, stored).filter(F.col("annee") >= 2000)))
    assert re.search(r"PartitionFilters: \[.*annee.*>= 2000", plan)


def scans(df):
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in final.split("== Initial Plan ==")[0].splitlines() if "FileScan" in line]


def test_predicting_every_region_reads_the_panel_once(spark, stored):
    cells = climatology.rain_cells(sources.read_parquet(spark, stored))
    assert len(scans(climatology.predict_all(cells, jobs.target_dates(None, 1)))) == 1


def test_no_raw_rows_are_shuffled_for_climatology(spark, stored):
    """The only exchange of raw rows is of partial aggregates."""
    plan = climatology.rain_cells(sources.read_parquet(spark, stored))._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange") < plan.index("partial_count") < plan.index("FileScan")


def test_filters_on_numbers_reach_the_scan(spark, stored):
    plan = plan_of(sources.read_parquet(spark, stored).filter("precipitations > 40"))
    assert "GreaterThan(precipitations,40.0)" in plan


def test_a_forecast_reads_the_panel_once(spark, stored):
    panel = sources.read_parquet(spark, stored)
    assert len(scans(forecast.forecast(forecast.monthly_series(panel), 12))) == 1


def test_ladder_predictions_share_one_reading(spark, stored):
    cells = climatology.weather_cells(sources.read_parquet(spark, stored))
    assert len(scans(climatology.expected_weather_all(cells, jobs.target_dates(None, 1)))) == 1


def nodes(plan):
    yield plan
    children = plan.children()
    for i in range(children.size()):
        yield from nodes(children.apply(i))


def sorted_raw_rows(df):
    """SortAggregate nodes that no hash aggregate parts from the scan."""
    def raw(plan):
        if plan.nodeName() == "HashAggregate":
            return False
        children = plan.children()
        return "Scan" in plan.nodeName() or any(raw(children.apply(i)) for i in range(children.size()))

    return [p for p in nodes(df._jdf.queryExecution().sparkPlan()) if p.nodeName() == "SortAggregate" and raw(p)]


@pytest.mark.parametrize("name", ["c8_deduplicate", "j1_join_predictions", "w5_ranked_extremes", "c9_densify", "l8_month_mean_forecast"])
def test_no_raw_rows_are_sorted_to_aggregate(spark, name):
    assert not sorted_raw_rows(QUERIES[name](spark, FOLDER))
    assert not sorted_raw_rows(star.panel(spark, FOLDER))


def test_text_beside_the_keys_is_not_sorted(spark, stored):
    panel = sources.read_parquet(spark, stored)
    both = joins.join_predictions(panel.select("date", "region", "type_sol"), panel.select("date", "region", "humidite"))
    assert not sorted_raw_rows(both) and both.count() == panel.count()


@pytest.fixture
def collected(monkeypatch):
    """Final plans of every collect, the library's own included."""
    from pyspark.sql.classic.dataframe import DataFrame
    plans, collect = [], DataFrame.collect

    def recorded(self):
        rows = collect(self)
        plans.append(self._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0])
        return rows

    monkeypatch.setattr(DataFrame, "collect", recorded)
    return plans


def test_cleaning_decides_from_one_reading(spark, stored, collected):
    panel = sources.read_parquet(spark, stored).withColumn("vent", F.when(F.col("vent") > 1, F.col("vent")))
    quality.plan_cleaning(panel)
    assert sum(p.count("FileScan") for p in collected) == 1 and "HashAggregate" in collected[0]
    collected.clear()
    quality.quality_report(panel).collect()
    assert sum(p.count("FileScan") for p in collected) == 1
    collected.clear()
    quality.clean(panel).collect()
    assert [p.count("FileScan") for p in collected] == [1, 1]


def test_one_scan_for_dense_days_and_chart_rows(spark, stored):
    panel = sources.read_parquet(spark, stored)
    assert len(scans(quality.densify(panel))) == 1
    for model in (forecast.fit_month_means, forecast.fit_seasonal_trend):
        fitted = model(forecast.monthly_series(panel))
        evaluate = forecast.forecast_month_means if model is forecast.fit_month_means else forecast.forecast_seasonal_trend
        assert len(scans(forecast.chart_rows(evaluate(fitted, observed=True)))) == 1


@pytest.mark.parametrize("threshold,join", [("10m", "BroadcastHashJoin"), ("100", "SortMergeJoin")])
def test_statistics_are_broadcast_by_their_real_size(spark, stored, threshold, join):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        panel = sources.read_parquet(spark, stored)
        for df in (windows.anomalies(panel), windows.allocate(panel, ["region", "annee"], "precipitations", "pression")):
            names = [p.nodeName() for p in nodes(df._jdf.queryExecution().sparkPlan())]
            assert [n for n in names if "Join" in n] == [join]
            assert len(scans(df)) == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_nothing_runs_before_a_region_is_asked_for(spark, stored):
    panel = sources.read_parquet(spark, stored)
    spark.sparkContext.setJobGroup("plan-time", "")
    series = forecast.region_or_all(forecast.monthly_series(panel), "NATION_3")
    jobs.predict_from_climatology(panel, "NATION_3", days=1)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("plan-time")
    spark.sparkContext.setJobGroup("", "")
    assert series.select("region").distinct().collect() == [("NATION_3",)]
    assert forecast.region_or_all(forecast.monthly_series(panel), "nowhere").select("region").distinct().count() > 1
