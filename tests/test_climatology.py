import datetime as dt
import statistics

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from rainpanel.operators import climatology as cl
from rainpanel.plans import jobs

SCHEMA = "region string, date date, precipitations double, latitude double, longitude double"


def day(y, m, d=1):
    return dt.date(y, m, d)


def brute(rows, region, when):
    """The rule, one request at a time, in plain Python."""
    mine = [r for r in rows if r[0] == region] or rows
    month = [r for r in mine if r[1].month == when.month] or mine
    values = [r[2] for r in month if r[2] is not None]
    years = sorted({r[1].year for r in month})
    trend = 0.0
    if len(years) >= 3:
        means = [np.mean([r[2] for r in month if r[1].year == y]) for y in years]
        trend = float(np.polyfit(np.array(years) - years[0], means, 1)[0])
    mean_year = np.mean([r[1].year for r in month])
    amount = max(0.0, np.mean(values) + trend * (when.year - mean_year))
    sd = statistics.stdev(values) if len(values) > 1 else None
    lat = [r[3] for r in mine if r[3] is not None]
    return amount, sd, len(month), len(years), trend, np.mean(lat) if lat else None


@pytest.fixture(scope="module")
def observed(spark):
    rng = np.random.default_rng(5)
    rows = [("A", day(y, m, d), float(rng.integers(0, 30)), 1.0, 2.0)
            for y in range(2001, 2007) for m in (1, 7) for d in range(1, 3 + (y == 2001) * 20)]
    rows += [("B", day(y, 3, d), float(y - 2000 + d), 4.0, None) for y in (2001, 2002) for d in (1, 2)]
    rows += [("C", day(2004, 1, 1), 9.0, None, None)]
    return rows, spark.createDataFrame(rows, SCHEMA)


REQUESTS = [("A", day(2010, 1)), ("A", day(2030, 7)), ("A", day(2010, 3)), ("B", day(2010, 3)), ("B", day(2010, 1)),
            ("C", day(2005, 1)), ("C", day(2005, 12)), ("nowhere", day(2010, 1)), ("nowhere", day(2010, 11))]


@pytest.mark.parametrize("region, when", REQUESTS)
def test_matches_brute_force(spark, observed, region, when):
    rows, df = observed
    requests = spark.createDataFrame([(region, when)], "region string, date date")
    got = cl.predict(requests, cl.rain_cells(df)).first()
    amount, sd, n, years, trend, lat = brute(rows, region, when)
    assert got["precipitation"] == pytest.approx(amount, abs=1e-9)
    assert got["std_deviation"] == (None if sd is None else pytest.approx(sd, abs=1e-9))
    assert (got["data_points"], got["years_of_data"]) == (n, years)
    assert got["annual_trend"] == pytest.approx(trend, abs=1e-9)
    assert got["latitude"] == (None if lat is None else pytest.approx(lat))


def test_two_years_give_no_trend_three_do(spark):
    def trend(years):
        df = spark.createDataFrame([("A", day(y, 5), float(y - 2000), None, None) for y in years], SCHEMA)
        return cl.predict_all(cl.rain_cells(df), [day(2010, 5)]).first()["annual_trend"]
    assert trend((2001, 2002)) == 0.0
    assert trend((2001, 2002, 2003)) == pytest.approx(1.0)


def test_clamped_at_zero_and_classified(spark):
    df = spark.createDataFrame([("A", day(y, 5), float(2010 - y), None, None) for y in range(2001, 2010)], SCHEMA)
    got = cl.predict_all(cl.rain_cells(df), [day(2050, 5)]).first()
    assert (got["precipitation"], got["category"]) == (0.0, "Temps sec")


def test_without_coordinates(spark):
    df = spark.createDataFrame([("A", day(2001, 5), 3.0)], "region string, date date, precipitations double")
    predicted = cl.predict_all(cl.rain_cells(df), [day(2002, 5)])
    assert predicted.first()["latitude"] is None
    assert cl.map_points(predicted).count() == 0


def test_missing_rain_counts_as_a_row_only(spark):
    df = spark.createDataFrame([("A", day(2001, 5), 3.0, 1.0, 1.0), ("A", day(2003, 5), None, 1.0, 1.0)], SCHEMA)
    got = cl.predict_all(cl.rain_cells(df), [day(2002, 5)]).first()
    assert (got["precipitation"], got["data_points"], got["years_of_data"]) == (3.0, 2, 2)


def test_hot_region_keeps_its_result(spark):
    df = spark.range(300_000).select(
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("r"), F.col("id") % 50)).alias("region"),
        F.date_add(F.lit(day(2001, 1)), (F.col("id") % 1500).cast("int")).alias("date"),
        (F.col("id") % 17).cast("double").alias("precipitations"),
    )
    got = cl.predict_all(cl.rain_cells(df), [day(2006, 1)]).filter("region = 'hot'").first()
    plain = df.filter("region = 'hot' and month(date) = 1").agg(F.count("*"), F.stddev_samp("precipitations")).first()
    assert got["data_points"] == plain[0]
    assert got["std_deviation"] == pytest.approx(plain[1])


def test_job_for_one_region_and_unknown_region(spark, observed):
    _, df = observed
    df = df.withColumn("mois", F.month("date"))
    assert [r["region"] for r in jobs.predict_from_climatology(df, "B", days=3, today=day(2010, 2, 26)).collect()] == ["B"]
    assert jobs.target_dates(None, 3, day(2010, 2, 26)) == [day(2010, 3, 1)]
    assert jobs.target_dates(["2025-5-1", "soon", day(2020, 1)], 2, day(2024, 12, 31)) == [day(2025, 5), day(2025, 1, 2), day(2020, 1)]
    with pytest.raises(PySparkException, match="nowhere"):
        jobs.predict_from_climatology(df, "nowhere").collect()


def test_weather_ladder(spark):
    rows = [("A", 1, 10.0, 4, "clay"), ("A", 1, 20.0, 7, "clay"), ("A", 2, 30.0, 1, "sand"), ("B", 1, None, None, None)]
    df = spark.createDataFrame(rows, "region string, mois int, humidite double, vent int, type_sol string")
    for c in ("temperature_min", "temperature_max", "pression", "latitude", "longitude"):
        df = df.withColumn(c, F.lit(1.0))
    df = df.withColumns({"altitude": F.lit(3), "distance_cote": F.lit(4)})
    requests = spark.createDataFrame(
        [("A", day(2020, 1)), ("A", day(2020, 9)), ("B", day(2020, 1)), ("Z", day(2020, 1))], "region string, date date")
    got = {(r["region"], r["mois"]): (r["humidite"], r["vent"], r["type_sol"])
           for r in cl.expected_weather(requests, cl.weather_cells(df)).collect()}
    assert got == {("A", 1): (15.0, 5, "clay"), ("A", 9): (20.0, 4, "clay"), ("B", 1): (0.0, 0, "Standard"),
                   ("Z", 1): (20.0, 4, "clay")}


def test_chart_and_bounds(spark, observed):
    _, df = observed
    predicted = cl.predict_all(cl.rain_cells(df), [day(2010, 1)])
    assert tuple(cl.map_bounds(predicted).first()) == (1.5, 2.5, 0.5, 1.5)
    assert {r["region"]: r["error_bar"] for r in cl.chart_values(predicted).collect()}["C"] is None
    assert [r["region"] for r in cl.summary_table(predicted).collect()] == ["A", "B", "C"]
