import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from rainpanel import SCHEMA, sources
from rainpanel.plans import jobs

ROW = ("A", dt.date(2020, 2, 29), 2020, 2, 29, 1.5, 20.0, 30.0, 50.0, 12, 1013.0, 14.7, -17.4, 10, "clay", 3)


@pytest.fixture
def folder(tmp_path):
    return lambda name: str(tmp_path / name)


def write_text(path, *lines):
    with open(path, "w") as out:
        out.write("\n".join(lines) + "\n")
    return path


HEADER = ",".join(f.name for f in SCHEMA)
GOOD = "A,2020-02-29,2020,2,29,1.5,20.0,30.0,50.0,12,1013.0,14.7,-17.4,10,clay,3"
BAD = "B,2020-02-31,2020,2,31,x,20.0,30.0,50.0,12,1013.0,14.7,-17.4,10,clay,3"


def test_csv_round_trip(spark, folder):
    sources.write_csv(sources.from_rows(spark, [ROW]), folder("a"))
    assert [tuple(r) for r in sources.read_csv(spark, folder("a")).collect()] == [ROW]


def test_bad_rows(spark, folder):
    path = write_text(folder("bad.csv"), HEADER, GOOD, BAD)
    loaded = sources.read_csv(spark, path)
    assert loaded.filter("region = 'B' and date is null and precipitations is null").count() == 1
    good, bad = sources.split_bad_rows(sources.read_csv(spark, path, bad_rows="keep"))
    assert ([r["region"] for r in good.collect()], [r[0] for r in bad.collect()]) == (["A"], [BAD])
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        sources.read_csv(spark, path, bad_rows="fail").collect()
    with pytest.raises(ValueError):
        sources.read_csv(spark, path, bad_rows="guess")


def test_rejects_of_a_real_csv(spark, folder):
    """Quoted header in another order, a record over two lines, good and bad, and a column too many."""
    names = [f.name for f in SCHEMA][::-1]
    header = ",".join(f'"{n}"' for n in [*names, "note"])

    def line(region, date, soil):
        values = dict(zip((f.name for f in SCHEMA), GOOD.split(","), strict=True)) | {"region": region, "date": date, "type_sol": soil}
        return ",".join(f'"{values[n]}"' for n in names) + ",extra"

    path = write_text(folder("q.csv"), header, line("A", "2020-02-29", "clay\nand, sand"), line("B", "2020-02-31", "two\nlines"), line("C", "2020-03-01", "x"))
    good, bad = sources.split_bad_rows(sources.read_csv(spark, path, bad_rows="keep"))
    assert good.columns == [f.name for f in SCHEMA]
    assert sorted((r["region"], r["type_sol"]) for r in good.collect()) == [("A", "clay\nand, sand"), ("C", "x")]
    rejected = [r[0] for r in bad.collect()]
    assert len(rejected) == 1 and "two\nlines" in rejected[0] and bad.count() == 1
    short = write_text(folder("short.csv"), "region,date", "A,2020-01-01")
    with pytest.raises(ValueError, match="missing"):
        sources.read_csv(spark, short, bad_rows="keep")


def test_read_by_name(spark, folder):
    path = write_text(folder("n.csv"), "note,precipitations,date,region", "hi,2.5,2020-01-02,A", "ho,NaN,oops,B")
    got = sorted(map(tuple, sources.read_csv_by_name(spark, path).collect()))
    assert got == [("hi", 2.5, dt.date(2020, 1, 2), "A"), ("ho", None, None, "B")]
    with pytest.raises(PySparkException):
        sources.read_csv_by_name(spark, path, strict=True).collect()
    short = write_text(folder("s.csv"), "date,region", "2020-01-02,A")
    with pytest.raises(ValueError, match="precipitations"):
        sources.read_csv_by_name(spark, short)


def test_inferred_and_text_dates(spark, folder):
    sources.write_csv(sources.from_rows(spark, [ROW]), folder("t"), date_pattern="yyyy-MM-dd")
    inferred = sources.read_csv_inferred(spark, folder("t"))
    assert dict(inferred.dtypes)["date"] == "date" and dict(inferred.dtypes)["vent"] == "int"


def test_year_folders_prune(spark, folder):
    other = ("B", dt.date(2021, 1, 1), 2021, 1, 1, *ROW[5:])
    sources.write_parquet(sources.from_rows(spark, [ROW, other]), folder("p"))
    one = sources.read_parquet(spark, folder("p")).filter(F.col("annee") == 2021)
    assert [r["region"] for r in one.collect()] == ["B"]
    assert len(one.inputFiles()) <= 2


def test_model_paths(spark, folder):
    assert sources.model_path("GBT", "/m/").endswith("/m/gbt_model")
    with pytest.raises(ValueError):
        sources.load_model(spark, "svm", folder("m"))
    with pytest.raises(FileNotFoundError):
        sources.load_model(spark, "rf", folder("m"))


def test_process_job(spark, folder):
    path = write_text(folder("in.csv"), HEADER, GOOD, BAD)
    jobs.process(spark, path, folder("out"), threshold=0.6)
    assert sources.read_csv(spark, folder("out")).count() == 1
