import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from rainpanel import sources
from rainpanel.operators import forecast as fc
from rainpanel.plans import jobs

SERIES = "region string, ds date, y double"


def months(n, first=2010):
    return [dt.date(first + i // 12, i % 12 + 1, 1) for i in range(n)]


def signal(day, slope):
    t = (day - dt.date(2010, 1, 1)).days / 365.25
    return 50 + slope * t + 10 * math.sin(2 * math.pi * t)


@pytest.fixture(scope="module")
def known(spark):
    rng = np.random.default_rng(3)
    rows = [(r, d, signal(d, s) + float(rng.normal(0, 0.5))) for r, s in (("up", 1.5), ("down", -1.0)) for d in months(120)]
    return spark.createDataFrame(rows, SERIES).cache()


@pytest.fixture(scope="module")
def both_models(known):
    return {
        "waves": fc.forecast_seasonal_trend(fc.fit_seasonal_trend(known), 24).cache(),
        "months": fc.forecast_month_means(fc.fit_month_means(known), 24).cache(),
    }


@pytest.mark.parametrize("model", ["waves", "months"])
def test_recovers_trend_and_season(known, both_models, model):
    rows = both_models[model].collect()
    assert len(rows) == 2 * (120 + 24)
    assert sum(not r["is_history"] for r in rows) == 48
    future = [r for r in rows if not r["is_history"]]
    errors = [r["yhat"] - signal(r["ds"], 1.5 if r["region"] == "up" else -1.0) for r in future]
    assert np.sqrt(np.mean(np.square(errors))) < 1.0
    assert all(r["yhat_lower"] <= r["yhat"] <= r["yhat_upper"] for r in rows)
    inside = np.mean([abs(e) < r["yhat_upper"] - r["yhat"] for e, r in zip(errors, future)])
    assert inside > 0.9


def test_interval_widens_with_distance(both_models):
    rows = both_models["waves"].filter("region = 'up'").orderBy("ds").collect()
    width = [r["yhat_upper"] - r["yhat_lower"] for r in rows]
    assert width[0] == pytest.approx(width[119]) and width[143] > width[121] > width[119]


def test_level_and_clip(known):
    narrow = fc.forecast(known, 12, level=0.5).filter("not is_history").agg(F.avg(F.col("yhat_upper") - F.col("yhat"))).first()[0]
    wide = fc.forecast(known, 12, level=0.95).filter("not is_history").agg(F.avg(F.col("yhat_upper") - F.col("yhat"))).first()[0]
    assert wide / narrow == pytest.approx(1.95996 / 0.67449, rel=1e-3)
    negative = known.withColumn("y", F.col("y") - 100)
    assert fc.forecast(negative, 12, clip=True).agg(F.max("yhat")).first()[0] == 0.0
    assert fc.forecast(negative, 12).agg(F.max("yhat")).first()[0] < 0


def test_same_result_for_any_layout(known):
    a = fc.forecast(known.repartition(2), 6).orderBy("region", "ds").collect()
    b = fc.forecast(known.repartition(13), 6).orderBy("region", "ds").collect()
    assert [r["yhat"] for r in a] == pytest.approx([r["yhat"] for r in b], abs=1e-6)


def test_monthly_waves_option(known):
    got = fc.forecast(known, 6, monthly=True)
    assert got.count() == 252
    assert got.agg(F.max(F.abs("yhat"))).first()[0] < 150


def test_calendars(spark):
    series = spark.createDataFrame([("A", dt.date(2024, 12, 1), 1.0), ("B", dt.date(2024, 1, 1), 1.0)], SERIES)
    starts = [r["ds"] for r in fc.future_calendar(series, 3).filter("region = 'A'").orderBy("ds").collect()]
    assert starts == [dt.date(2025, 1, 1), dt.date(2025, 2, 1), dt.date(2025, 3, 1)]
    ends = fc.future_calendar(series, 120, "month_end").filter("region = 'A'").agg(F.min("ds"), F.max("ds"), F.count("*")).first()
    assert tuple(ends) == (dt.date(2024, 12, 31), dt.date(2034, 11, 30), 120)
    with pytest.raises(ValueError):
        fc.future_calendar(series, 3, "weekly")
    with pytest.raises(ValueError):
        fc.future_calendar(series, 0)


@pytest.mark.parametrize("mode, month", [("month_start", 8), ("month_end", 7)])
def test_august_peak(spark, mode, month):
    """Month ends carry the season of the following month start."""
    series = spark.createDataFrame([("A", d, 31.0 if d.month == 8 else 0.0) for d in months(120)], SERIES)
    future = fc.forecast(series, 120, mode).filter("not is_history")
    assert fc.trend_report(future).first()["wettest_month"] == month


def test_every_length_has_a_forecast(spark):
    lengths = {"one": 1, "two": 2, "short": 12, "nearly": 23, "two_years": 24, "long": 36}
    rows = [(r, d, 5.0 + d.month) for r, n in lengths.items() for d in months(n)] + [("none", dt.date(2020, 1, 1), None)]
    series = spark.createDataFrame(rows, SERIES)
    got = fc.forecast(series, 6).collect()
    assert {r: sum(x["region"] == r for x in got) for r in lengths} == {r: n + 6 for r, n in lengths.items()}
    assert all(-5 < x["yhat"] < 30 for x in got)
    assert all((x["yhat_lower"] is None) == (x["region"] == "one") for x in got)
    assert [x["yhat"] for x in got if x["region"] == "one"] == pytest.approx([6.0] * 7, abs=1.0)
    assert [tuple(r) for r in fc.without_months(series).collect()] == [("none", 0)]
    ones = fc.forecast_month_means(fc.fit_month_means(series.filter("region = 'one'")), 3).collect()
    assert [(x["yhat"], x["yhat_lower"]) for x in ones] == [(6.0, None)] * 4


@pytest.mark.parametrize("yearly", [True, False])
@pytest.mark.parametrize("monthly", [True, False])
def test_coefficients_know_their_waves(spark, known, tmp_path, yearly, monthly):
    fitted = fc.fit_seasonal_trend(known, yearly, monthly)
    sources.save_coefficients(fitted, str(tmp_path / "c"))
    again = fc.forecast_seasonal_trend(sources.load_coefficients(spark, str(tmp_path / "c")), 6).orderBy("region", "ds").collect()
    direct = fc.forecast(known, 6, yearly=yearly, monthly=monthly).orderBy("region", "ds").collect()
    assert [r["yhat"] for r in again] == pytest.approx([r["yhat"] for r in direct], abs=1e-6)


def test_copies_do_not_lose_a_short_region(spark):
    rows = [("A", d, float(d.month)) for d in months(15) for _ in range(3)]
    assert fc.forecast(spark.createDataFrame(rows, SERIES), 6).count() == 21


def report_of(spark, yearly):
    rows = [("A", dt.date(y, m, 1), float(v)) for y, v in yearly.items() for m in (3, 9)]
    return fc.trend_report(spark.createDataFrame(rows, "region string, ds date, yhat double")).first()


def test_trend_report(spark):
    got = report_of(spark, {2001: 2.0, 2002: 4.0, 2003: 4.0, 2004: 2.0})
    assert (got["wettest_year"], got["driest_year"], got["wettest_month"], got["driest_month"]) == (2002, 2001, 3, 3)
    assert (got["trend_direction"], got["pct_change"], got["start_year"], got["end_year"]) == ("à la baisse", 0.0, 2001, 2004)
    assert report_of(spark, {2001: 0.0, 2002: 3.0})["pct_change"] == math.inf
    assert report_of(spark, {2001: 0.0, 2002: 0.0})["pct_change"] == 0.0
    assert report_of(spark, {2001: 4.0, 2002: 6.0})["pct_change"] == 50.0
    assert report_of(spark, {2001: 4.0}) is None


def test_full_years(spark):
    rows = [("A", d, 1.0) for d in months(15)]
    series = spark.createDataFrame(rows, "region string, ds date, yhat double")
    assert fc.full_years(series).count() == 12
    assert fc.trend_report(series, full_years_only=True).count() == 0


def test_coefficients_saved_and_used_again(spark, known, tmp_path):
    fitted = fc.fit_seasonal_trend(known)
    sources.save_coefficients(fitted, str(tmp_path / "c"))
    before = fc.forecast_seasonal_trend(fitted, 12).orderBy("region", "ds").collect()
    after = fc.forecast_seasonal_trend(sources.load_coefficients(spark, str(tmp_path / "c")), 12).orderBy("region", "ds").collect()
    assert [r["yhat"] for r in before] == pytest.approx([r["yhat"] for r in after])
    assert sources.load_coefficients(spark, str(tmp_path / "c"), "up").count() == 1


def test_copies_of_a_day_change_nothing(spark, known):
    many = known.crossJoin(spark.range(20)).drop("id")
    one = fc.fit_seasonal_trend(known).orderBy("region").collect()
    copied = fc.fit_seasonal_trend(many).orderBy("region").collect()
    assert [r["slope"] for r in one] == pytest.approx([r["slope"] for r in copied], abs=1e-6)


def test_long_term_job(spark):
    rows = [(r, dt.date(2010, 1, 1) + dt.timedelta(days=i), float(i % 7)) for r in ("A", "B") for i in range(0, 1500, 2)]
    df = spark.createDataFrame(rows, "region string, date date, precipitations double")
    result = jobs.predict_long_term(df, "A", years=2)
    assert [r["region"] for r in result.report.collect()] == ["A"]
    assert result.forecast.filter("not is_history").count() == 24
    assert result.pattern.count() == 12 and result.pattern.first()["label"] == "Jan"
    unknown = jobs.predict_long_term(df, "unknown", years=1)
    assert unknown.report.count() == 2 and [tuple(r) for r in unknown.rejects.collect()] == [("unknown", 0)]
    assert result.rejects.count() == 0
    chart = fc.chart_rows(result.forecast, result.series)
    assert chart.filter("y is null").count() == 24
    assert fc.horizon_years(result.forecast).first()["years"] == 6


def test_hold_out(spark, known):
    days = known.select("region", F.col("ds").alias("date"), F.col("y").alias("precipitations"))
    got = {r["region"]: r for r in jobs.hold_out_long_term(days, 2018).collect()}
    assert {r: got[r]["n"] for r in got} == {"up": 24, "down": 24}
    assert all(r["rmse"] < 1.5 and r["r2"] > 0.9 and r["mae"] <= r["rmse"] for r in got.values())
    assert jobs.hold_out_long_term(days, 1990).count() == 0
    with pytest.raises(ValueError):
        jobs.hold_out_long_term(days, 2018, "other")
