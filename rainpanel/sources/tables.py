"""Reading and writing observation tables."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from rainpanel.functions.calendar import ISO_FORMAT, date_text, parse_date
from rainpanel.schema import REQUIRED_COLUMNS, SCHEMA, nan_to_null, require_columns

BAD_ROW = "_bad_row"


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType = SCHEMA, bad_rows: str = "null", multiline: bool = True,
) -> DataFrame:
    """CSV with a header and a fixed schema.

    ``bad_rows``: ``"null"`` leaves unreadable fields NULL, ``"keep"`` also adds the raw record as
    ``_bad_row`` (NULL for a good row), ``"fail"`` stops at the first bad row.

    With ``"keep"``, columns are found by the header's names, quoted or not, and a record may go over
    several lines inside quotes. A file is then read by one task; ``multiline=False`` splits files whose
    records are known to be single lines.
    """
    if bad_rows not in ("null", "keep", "fail"):
        raise ValueError(f"bad_rows must be null, keep or fail, not {bad_rows!r}")
    reader = spark.read.option("header", True).option("dateFormat", ISO_FORMAT)
    if bad_rows == "fail":
        reader = reader.option("mode", "FAILFAST")
    if bad_rows == "keep":
        return nan_to_null(_with_bad_rows(spark, path, schema, multiline))
    return nan_to_null(reader.schema(schema).csv(path))


def _with_bad_rows(spark: SparkSession, path: str, schema: T.StructType, multiline: bool) -> DataFrame:
    """Records by Spark's own reader, in the order of columns that the header names; others are left out."""
    records = spark.read.option("header", True).option("multiLine", multiline)
    header = require_columns(records.csv(path), schema.fieldNames()).columns
    types = {f.name: f.dataType for f in schema}
    fields = [T.StructField(name, types.get(name, T.StringType())) for name in header]
    reader = records.schema(T.StructType([*fields, T.StructField(BAD_ROW, T.StringType())])).option("mode", "PERMISSIVE")
    rows = reader.option("dateFormat", ISO_FORMAT).option("columnNameOfCorruptRecord", BAD_ROW).csv(path)
    # Spark looks for faults only in the fields that a query needs, so the mark is made to need them all.
    every = F.xxhash64(*schema.fieldNames()) != 0
    mark = F.when(F.col(BAD_ROW).isNull() & every, None).otherwise(F.col(BAD_ROW))
    return rows.select(*schema.fieldNames(), mark.alias(BAD_ROW))


def read_csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header and types found by a first pass over the data."""
    return nan_to_null(spark.read.option("header", True).option("inferSchema", True).csv(path))


def read_csv_by_name(
    spark: SparkSession, path: str, required: Iterable[str] = REQUIRED_COLUMNS, strict: bool = False
) -> DataFrame:
    """CSV whose columns are found by header name, in any order, with extra columns left as text.

    Raises ``ValueError`` when a required column is absent. Unreadable dates and numbers become
    NULL, or stop the job when ``strict``. Types come from the schema, so there is no inference pass.
    """
    raw = require_columns(spark.read.option("header", True).csv(path), required)
    types = {f.name: f.dataType for f in SCHEMA}

    def typed(name: str):
        dtype = types.get(name, T.StringType())
        if isinstance(dtype, T.DateType):
            return parse_date(name, strict=strict).alias(name)
        column = F.col(name)
        return (column.cast(dtype) if strict else column.try_cast(dtype)).alias(name)

    return nan_to_null(raw.select(*[typed(name) for name in raw.columns]))


def read_parquet(spark: SparkSession, path: str, normalise: bool = False) -> DataFrame:
    """Parquet as :func:`write_parquet` leaves it, without NaN, so that filters on numbers reach the files.

    ``normalise`` turns the NaN of foreign files into NULL, at the price of those filters.
    """
    df = require_columns(spark.read.parquet(path))
    return nan_to_null(df) if normalise else df


def from_rows(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType = SCHEMA) -> DataFrame:
    """Observation rows given by the caller, in schema order."""
    return spark.createDataFrame(rows, schema)


def split_bad_rows(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good rows and rejected records of a frame read with ``bad_rows="keep"``."""
    good = df.filter(F.col(BAD_ROW).isNull()).drop(BAD_ROW)
    return good, df.filter(F.col(BAD_ROW).isNotNull()).select(BAD_ROW)


def write_csv(df: DataFrame, path: str, date_pattern: str | None = None) -> None:
    """CSV folder with a header, replacing what is there; dates as text when a pattern is given."""
    if date_pattern is not None:
        dates = [f.name for f in df.schema if isinstance(f.dataType, T.DateType)]
        df = df.withColumns({name: date_text(name, date_pattern) for name in dates})
    df.write.mode("overwrite").option("header", True).option("dateFormat", ISO_FORMAT).csv(path)


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ("annee",)) -> None:
    """Parquet folder, one sub-folder per year by default, so a year filter prunes whole folders.

    The rebalance hint lets Spark gather a year's rows into files of the advised size and split a
    year that holds far more rows than the others.
    """
    df = nan_to_null(df)
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def use_checkpoint_folder(spark: SparkSession) -> str | None:
    """The session's shared checkpoint folder, made known to its context; None when it names none."""
    known = spark.sparkContext.getCheckpointDir()
    if known:
        return known
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def size_in_bytes(df: DataFrame) -> int:
    """Bytes of the rows in memory, about, by one reading: eight for each number, texts by their length."""
    def width(field: T.StructField) -> Column:
        return F.coalesce(F.octet_length(field.name), F.lit(0)) + 16 if isinstance(field.dataType, T.StringType) else F.lit(8)

    row = sum((width(f) for f in df.schema), F.lit(16))
    return df.agg(F.coalesce(F.sum(row), F.lit(0))).first()[0]


def measured(df: DataFrame) -> DataFrame:
    """A small side of a join, settled and measured: with a hint to broadcast it, or to sort and merge.

    It is broadcast only if its real size is below ``spark.sql.autoBroadcastJoinThreshold``. Without a
    checkpoint folder nothing is settled and the choice stays with Spark.
    """
    spark = df.sparkSession
    if not use_checkpoint_folder(spark):
        return df
    ready = df.checkpoint()
    text = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    limit = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(text) if text != "-1" else -1
    return ready.hint("broadcast" if size_in_bytes(ready) <= limit else "merge")


def settled(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder once and go on from there.

    For a small result of a long reading that several later steps use. Without a folder the frame
    stays as it is and Spark works it out anew for each use.
    """
    return df.checkpoint() if use_checkpoint_folder(df.sparkSession) else df
