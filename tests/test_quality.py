import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from rainpanel.operators import quality

D = dt.date(2020, 1, 1)


def test_profile_counts_null_and_nan(spark):
    df = spark.createDataFrame([(1.5, 1, "a"), (math.nan, None, None), (None, 2, "b"), (4.0, 3, "c")], "p double, i int, s string")
    got = {r["column"]: (r["n_rows"], r["nulls"], r["ratio"]) for r in quality.missing_profile(df).collect()}
    assert got == {"p": (4, 2, 0.5), "i": (4, 1, 0.25), "s": (4, 1, 0.25)}
    assert quality.drop_missing(df, "p").count() == 2
    assert quality.drop_missing(df, "s").count() == 3
    assert quality.drop_any_missing(df).count() == 2


def test_threshold_is_strict(spark):
    at = spark.createDataFrame([(None if i < 1 else 1.0,) for i in range(20)], "precipitations double")
    above = spark.createDataFrame([(None if i < 2 else 1.0,) for i in range(20)], "precipitations double")
    assert quality.plan_cleaning(at).actions == {"precipitations": "drop_rows"}
    assert quality.clean(at).count() == 19
    assert quality.plan_cleaning(above).actions == {"precipitations": "fill_mean"}
    assert quality.clean(above).filter("precipitations = 1.0").count() == 20


def test_mean_is_taken_after_earlier_drops(spark):
    data = [(float(i), 10.0) for i in range(18)] + [(None, 1000.0), (1.0, None)]
    df = spark.createDataFrame(data, "precipitations double, temperature_min double")
    plan = quality.plan_cleaning(df, threshold=0.05)
    assert plan.actions == {"precipitations": "drop_rows", "temperature_min": "drop_rows"}
    rare = spark.createDataFrame(data + [(1.0, None)] * 3 + [(2.0, 10.0)], "precipitations double, temperature_min double")
    plan = quality.plan_cleaning(rare, threshold=0.05)
    assert plan.actions == {"precipitations": "drop_rows", "temperature_min": "fill_mean"}
    assert plan.means == {"temperature_min": 10.0}


def test_nan_is_filled_with_the_mean_of_the_rest(spark):
    df = spark.createDataFrame([(1.5,), (math.nan,), (None,), (4.5,)], "humidite double")
    assert sorted(r[0] for r in quality.clean(df).collect()) == [1.5, 3.0, 3.0, 4.5]


def test_integer_mean_is_truncated(spark):
    df = spark.createDataFrame([(3,), (7,), (4,), (None,)], "vent int")
    cleaned = quality.clean(df)
    assert sorted(r[0] for r in cleaned.collect()) == [3, 4, 4, 7]
    assert cleaned.schema["vent"].dataType.simpleString() == "int"


def test_soil_constant_other_texts_kept(spark):
    df = spark.createDataFrame([(None, None), ("x", "A")], "type_sol string, region string")
    assert sorted(map(tuple, quality.clean(df).collect()), key=str) == [("Standard", None), ("x", "A")]


def test_all_null_and_empty(spark):
    nothing = spark.createDataFrame([(None, "A"), (None, "B")], "precipitations double, region string")
    assert quality.clean(nothing).count() == 2
    empty = spark.createDataFrame([], "precipitations double, region string")
    assert quality.clean(empty).count() == 0
    report = {r["column"]: r["rows_before"] for r in quality.quality_report(empty).collect()}
    assert report == {"precipitations": 0, "region": 0}


def test_quality_report(spark):
    df = spark.createDataFrame([(1.0, None)] + [(2.0, 5)] * 9, "precipitations double, vent int")
    got = {r["column"]: (r["nulls_before"], r["nulls_after"], r["action"], r["rows_after"]) for r in quality.quality_report(df).collect()}
    assert got == {"precipitations": (0, 0, "keep", 10), "vent": (1, 0, "fill_mean", 10)}


def test_fill_defaults(spark):
    df = spark.createDataFrame([(None, 3.9, None), (math.nan, None, "x")], "humidite double, vent double, type_sol string")
    assert sorted(map(tuple, quality.fill_defaults(df).collect())) == [(0.0, 0, "x"), (0.0, 3, "Standard")]


def test_deduplicate_is_deterministic(spark):
    df = spark.createDataFrame([("A", D, 2.0), ("A", D, 1.0), ("A", D, 1.0), ("B", D, 3.0)], "region string, date date, p double")
    for n in (1, 7):
        got = sorted(map(tuple, quality.deduplicate(df.repartition(n)).collect()))
        assert got == [("A", D, 1.0), ("B", D, 3.0)]


def test_deduplicate_hot_key(spark):
    df = spark.range(200_000).select(
        F.when(F.col("id") < 150_000, "hot").otherwise(F.concat(F.lit("r"), F.col("id") % 100)).alias("region"),
        F.lit(D).alias("date"), F.col("id").cast("double").alias("p"),
    )
    got = quality.deduplicate(df)
    assert got.count() == 101
    assert got.filter("region = 'hot'").first()["p"] == 0.0


@pytest.mark.parametrize("whole, days", [(True, 29), (False, 11)])
def test_densify_leap_february(spark, whole, days):
    df = spark.createDataFrame([("A", dt.date(2024, 2, 10), 5.0), ("A", dt.date(2024, 2, 20), 1.0)], "region string, date date, precipitations double")
    dense = quality.densify(df, whole_months=whole)
    assert dense.count() == days
    assert dense.agg(F.sum("precipitations")).first()[0] == 6.0
    assert dense.filter("date = date'2024-02-11'").first()["precipitations"] == 0.0


def test_pattern_table_answers_for_any_part(spark):
    rows = [(1.0, None, "a"), (None, 2, "a"), (3.0, 4, None), (math.nan, None, "b"), (5.0, 6, "c"), (5.0, 6, "c")]
    patterns = quality.missing_patterns(spark.createDataFrame(rows, "precipitations double, vent int, type_sol string"))
    assert patterns.rows() == 6 and len(patterns.sets) == 5
    assert (patterns.nulls("vent"), patterns.nulls("vent", ["precipitations"])) == (2, 1)
    assert patterns.mean("precipitations", ["vent"]) == 13 / 3
    assert patterns.mean("vent", ["vent", "precipitations"]) == 16 / 3


def test_more_columns_than_bits_in_a_word(spark):
    names = [f"c{i}" for i in range(130)]
    df = spark.range(10).select(*[F.when(F.col("id") >= i % 7, F.col("id")).alias(n) for i, n in enumerate(names)])
    patterns = quality.missing_patterns(df)
    assert [patterns.nulls(n) for n in names] == [i % 7 for i in range(130)]


def test_report_foretells_what_cleaning_leaves(spark):
    rows = [(None if i % 30 == 0 else 1.0 * i, None if i % 4 == 0 else i, None if i % 3 == 0 else "clay", None) for i in range(90)]
    df = spark.createDataFrame(rows, "precipitations double, vent int, type_sol string, altitude int")
    cleaned = quality.clean(df)
    after = {r["column"]: (r["nulls"], r["n_rows"]) for r in quality.missing_profile(cleaned).collect()}
    assert {r["column"]: (r["nulls_after"], r["rows_after"]) for r in quality.quality_report(df).collect()} == after
    assert after["precipitations"] == (0, 87) and after["altitude"] == (87, 87)


def test_deduplicate_hot_key_and_null_keys(spark):
    rows = [("A", D, 5.0, "x")] * 200 + [("A", D, 5.0, None), ("A", D, 4.0, "z"), (None, D, 1.0, "n"), (None, D, 1.0, "m"), ("B", None, 2.0, "b")]
    df = spark.createDataFrame(rows, "region string, date date, p double, s string").repartition(5)
    got = sorted(map(tuple, quality.deduplicate(df).collect()), key=str)
    assert got == sorted([("A", D, 4.0, "z"), (None, D, 1.0, "m"), ("B", None, 2.0, "b")], key=str)


def test_densify_fills_months_without_a_record(spark):
    rows = [("A", dt.date(2020, 1, 30), 1.0), ("A", dt.date(2020, 4, 2), None), ("B", dt.date(2020, 2, 10), 2.0)]
    df = spark.createDataFrame(rows, "region string, date date, precipitations double")
    whole = {(r.region, r.date): r.precipitations for r in quality.densify(df).collect()}
    assert len(whole) == 31 + 29 + 31 + 30 + 29 and whole["A", dt.date(2020, 3, 15)] == 0.0
    assert whole["A", dt.date(2020, 4, 2)] is None and whole["B", dt.date(2020, 2, 10)] == 2.0
    span = {(r.region, r.date) for r in quality.densify(df, whole_months=False).collect()}
    assert len(span) == 2 + 29 + 31 + 2 + 1 and min(span) == ("A", dt.date(2020, 1, 30))
    with pytest.raises(Exception, match="more than one row"):
        quality.densify(df.unionAll(df)).collect()
