import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from rainpanel import functions as fn
from rainpanel.plans import jobs


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


@pytest.mark.parametrize("mm, label", [
    (-1.0, "Temps sec"), (0.0, "Temps sec"), (0.0999, "Temps sec"), (0.1, "Pluie légère"),
    (4.999, "Pluie légère"), (5.0, "Pluie modérée"), (19.999, "Pluie modérée"), (20.0, "Forte pluie"),
    (None, None), (math.nan, None),
])
def test_rain_class(spark, mm, label):
    assert one(spark, fn.rain_class(F.lit(mm).cast("double"))) == (label,)


def test_season_edges(spark):
    df = spark.createDataFrame([(m,) for m in (5, 6, 10, 11)], "m int").select(fn.season("m"))
    assert [r[0] for r in df.collect()] == ["saison_seche", "saison_pluies", "saison_pluies", "saison_seche"]


def test_clamps(spark):
    nan, null = F.lit(math.nan), F.lit(None).cast("double")
    assert one(spark, fn.at_least_zero(F.lit(-2.0)), fn.at_least_zero(F.lit(3.0))) == (0.0, 3.0)
    assert one(spark, fn.at_least_zero(nan), fn.at_least_zero(null)) == (None, None)
    assert one(spark, fn.clamp(F.lit(9.0), 1, 5), fn.clamp(F.lit(0.0), 1, 5), fn.clamp(F.lit(2.0))) == (5.0, 1.0, 2.0)


def test_axis_top(spark):
    null = F.lit(None).cast("double")
    assert one(spark, fn.axis_top(F.lit(0.0), null), fn.axis_top(F.lit(100.0), F.lit(2.0)), fn.axis_top(F.lit(1.0), F.lit(4.0))) \
        == (5.0, 150.0, 14.0)


def test_target_date(spark):
    reference = F.lit(dt.date(2024, 12, 31))
    got = one(spark, fn.target_date(F.lit("2025-05-01"), reference), fn.target_date(F.lit("soon"), reference),
              fn.target_date(F.lit(None).cast("string"), reference, 5))
    assert got == (dt.date(2025, 5, 1), dt.date(2025, 1, 1), dt.date(2025, 1, 5))


def test_dates_and_texts(spark):
    day = F.lit(dt.date(2024, 2, 29))
    assert one(spark, fn.date_text(day), fn.month_start(day), fn.month_index(day), fn.month_label(F.month(day))) \
        == ("29/02/2024", dt.date(2024, 2, 1), 2024 * 12 + 1, "Fév")
    assert one(spark, fn.month_date(F.lit(2020), F.lit(3)), fn.parse_date(F.lit("2020-13-01"))) == (dt.date(2020, 3, 1), None)
    assert one(spark, fn.file_key(F.lit("a b c")), fn.report_key(F.lit("a b"), day)) == ("a_b_c", "prediction_a_b_20240229")
    assert one(spark, fn.fixed(F.lit(2.345)), fn.fixed(F.lit(2.0), 1)) == ("2.35", "2.0")
    assert one(spark, fn.table_line(F.lit("A"), F.lit(1.5), F.lit("dry"))) == (f"{'A':<15} {'1.50':<20} {'dry':<15}",)


def test_cyclic_neighbours(spark):
    first, last = F.lit(dt.date(2023, 1, 1)), F.lit(dt.date(2023, 12, 31))
    a = one(spark, *fn.cyclic_day(first))
    b = one(spark, *fn.cyclic_day(last))
    assert math.dist(a, b) < 0.03
    assert one(spark, *fn.cyclic_month(F.lit(12)))[1] == pytest.approx(1.0)


def test_both_forms_read_the_same_dates(spark):
    texts = ["2024-01-05", "2024-1-5", "24-1-5", "2024-1_0-5", "2024-13-01", "2024-02-30", "05/01/2024", "", "soon", "2024-1"]
    today, rows = dt.date(2020, 5, 1), []
    for text in texts:
        rows.append((text, jobs.target_dates([text], 1, today)[0]))
    frame = spark.createDataFrame(rows, "text string, expected date").withColumn("ref", F.lit(today))
    assert frame.filter(~fn.target_date("text", "ref", 1).eqNullSafe(F.col("expected"))).collect() == []
