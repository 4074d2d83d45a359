import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from rainpanel.operators import explore, joins, windows
from rainpanel.schema import nan_to_null

D = dt.date


def test_nan_is_ignored_in_means(spark):
    df = spark.createDataFrame([("A", 1.5), ("A", float("nan")), ("A", None), ("A", 4.5)], "region string, precipitations double")
    assert explore.mean_per_region(nan_to_null(df)).first()["precipitations_moyennes"] == 3.0


def test_most_frequent_tie_goes_to_smallest(spark):
    df = spark.createDataFrame([("A", "x"), ("A", "b"), ("A", "b"), ("A", "x"), ("B", None)], "region string, soil string")
    got = {r["region"]: (r["soil"], r["n"]) for r in explore.most_frequent(df, ["region"], "soil").collect()}
    assert got == {"A": ("b", 2), "B": (None, 1)}


def test_totals_divide_by_own_years(spark):
    df = spark.createDataFrame([("A", 2001, 1, 10.0), ("A", 2002, 1, 30.0), ("B", 2001, 2, 8.0)],
                               "region string, annee int, mois int, precipitations double")
    got = {r["region"]: (r["n_years"], r["precipitations_annuelles"]) for r in explore.mean_annual_total(df).collect()}
    assert got == {"A": (2, 20.0), "B": (1, 8.0)}
    profile = {r["region"]: (r["m1"], r["m2"]) for r in explore.month_profile(df).collect()}
    assert profile == {"A": (20.0, None), "B": (None, 8.0)}
    assert explore.interannual_variability(df).filter("region = 'B'").first()["sd_total"] is None


def test_sample_is_exact_and_stable(spark):
    df = spark.range(5000).select(F.col("id").cast("string").alias("region"), F.lit(D(2020, 1, 1)).alias("date"))
    a = {r["region"] for r in explore.fixed_sample(df.repartition(3)).collect()}
    b = {r["region"] for r in explore.fixed_sample(df.repartition(11)).collect()}
    assert len(a) == 1000 and a == b
    assert explore.fixed_sample(df.limit(7)).count() == 7
    assert {r["region"] for r in explore.fixed_sample(df, seed=1).collect()} != a


def test_describe_keeps_texts_apart(spark):
    df = spark.createDataFrame([(1, "b", D(2020, 1, 1)), (3, "a", None)], "n int, s string, d date")
    got = {r["column"]: tuple(r)[1:] for r in explore.describe_columns(df).collect()}
    assert got["s"] == (2, None, None, None, None, "a", "b")
    assert got["n"][:2] == (2, 2.0) and got["n"][3:] == (1.0, 3.0, None, None)
    assert set(got) == {"n", "s"}


def panel(spark, rows):
    return spark.createDataFrame(rows, "region string, date date, precipitations double")


def test_rolling_mean_by_days_and_copies(spark):
    df = panel(spark, [("A", D(2020, 1, 1), 2.0), ("A", D(2020, 1, 1), 4.0), ("A", D(2020, 1, 2), None),
                       ("A", D(2020, 1, 3), 9.0), ("A", D(2020, 1, 10), 1.0)])
    got = [(r["date"].day, r["mean_3d"]) for r in windows.rolling_mean(df, days=(3,)).orderBy("date").collect()]
    assert got == [(1, 3.0), (2, 3.0), (3, 5.0), (10, 1.0)]


def test_trend_indicators(spark):
    df = panel(spark, [("A", D(2020, 1, d), float(2 * d)) for d in range(1, 6)])
    got = windows.trend_indicators(df, days=3).orderBy("date").collect()
    assert [r["change"] for r in got] == [None, 2.0, 2.0, 2.0, 2.0]
    assert got[0]["slope_3d"] is None and got[-1]["slope_3d"] == pytest.approx(2.0)


def test_allocate_and_anomalies(spark):
    df = spark.createDataFrame([("A", 1.0, 10.0), ("A", 3.0, 10.0), ("B", 0.0, 5.0), (None, 2.0, 7.0)], "k string, w double, total double")
    got = {(r["k"], r["w"]): r["allocated"] for r in windows.allocate(df, ["k"], "w", "total").collect()}
    assert got == {("A", 1.0): 2.5, ("A", 3.0): 7.5, ("B", 0.0): None, (None, 2.0): 7.0}
    rain = spark.createDataFrame([("A", 1, 0.0)] * 20 + [("A", 1, 100.0), ("B", 1, 5.0)], "region string, mois int, precipitations double")
    flagged = windows.anomalies(rain)
    assert [r["precipitations"] for r in flagged.filter("is_anomaly").collect()] == [100.0]
    assert flagged.filter("region = 'B'").first()["z"] is None


def test_join_refuses_copies_of_a_key(spark):
    left = panel(spark, [("A", D(2020, 1, 1), 1.0), ("A", D(2020, 1, 2), 1.0)])
    right = left.withColumnRenamed("precipitations", "other").limit(1)
    assert joins.join_predictions(left, right).count() == 1
    twice = right.unionByName(right)
    with pytest.raises(PySparkException, match="more than one row"):
        joins.join_predictions(left, twice).count()


def test_region_attributes_keep_unmatched_rows(spark):
    facts = panel(spark, [("A", D(2020, 1, 1), 1.0), ("Z", D(2020, 1, 1), 2.0), ("Z", D(2020, 1, 2), 2.0)])
    dim = spark.createDataFrame([("A", 10)], "region string, altitude int")
    assert {(r["region"], r["altitude"]) for r in joins.add_region_attributes(facts, dim).collect()} == {("A", 10), ("Z", None)}
    assert [tuple(r) for r in joins.regions_without_attributes(facts, dim).collect()] == [("Z", 2)]


def test_requests(spark):
    regions = spark.createDataFrame([("A",), ("B",)], "region string")
    days = [D(2020, 1, 2), D(2020, 1, 1), D(2020, 1, 1)]
    requests = joins.requests_for(regions, days)
    assert requests.count() == 4
    assert joins.requests_between(regions, D(2020, 2, 27), D(2020, 3, 1)).count() == 8
    seen = panel(spark, [("A", D(2019, 1, 1), 1.0)])
    assert {r["region"] for r in joins.known_requests(requests, seen).collect()} == {"A"}
    assert {r["region"] for r in joins.unknown_requests(requests, seen).collect()} == {"B"}


def test_blocks_give_what_one_window_gives(spark):
    """A hundred years of a region with gaps, in blocks of a few weeks, of years, and in one."""
    import datetime as dt
    day0 = dt.date(1920, 1, 1)
    rows = [("A", day0 + dt.timedelta(days=i), float(i * 37 % 101)) for i in range(0, 36_500, 3) if not 5_000 < i < 9_000]
    rows += [("B", day0 + dt.timedelta(days=i), None if i % 5 == 0 else float(i)) for i in (0, 1, 5, 40, 41, 200, 2_000)]
    rows += [(None, day0, 1.0), (None, day0 + dt.timedelta(days=1), 3.0)]
    df = spark.createDataFrame(rows, "region string, date date, precipitations double").repartition(8)

    def result(operator, size):
        return sorted((tuple(None if v is None else round(v, 6) if isinstance(v, float) else v for v in r)
                       for r in operator(df, block_days=size).collect()), key=str)

    for operator in (windows.rolling_mean, windows.trend_indicators):
        whole = result(operator, 100_000)
        assert len(whole) == len(rows)
        assert result(operator, 10) == whole and result(operator, windows.BLOCK_DAYS) == whole
    blocks = windows._in_blocks(windows._daily(df, "precipitations"), 29, windows.BLOCK_DAYS)
    assert blocks.filter("region = 'A'").select("_block").distinct().count() > 20


def test_anomaly_flags_are_never_null(spark):
    df = spark.createDataFrame([("A", 1, 5.0), ("A", 1, None), ("B", 1, 2.0)], "region string, mois int, precipitations double")
    assert all(r.is_anomaly is False for r in windows.anomalies(df).collect())


def test_a_repeated_key_beside_text_stops_the_job(spark):
    df = spark.createDataFrame([("A", 1, "x"), ("A", 1, "y")], "region string, date int, s string")
    with pytest.raises(Exception, match="more than one row for"):
        joins.unique_on(df, ["region", "date"]).collect()
    assert joins.unique_on(df.limit(1), ["region", "date"]).count() == 1
