"""Adapter: observation tables made from a TPC-H style star schema.

Rows: one observation per line item, placed by ship date and the customer's nation.
Panel: those rows reduced to one per (region, date). All measures are whole numbers, so sums do not
depend on the order of addition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rainpanel.schema import with_date_parts


# Columns in use; a given schema also spares the job that reads one from the file.
TABLES = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_nationkey int, c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint",
    "lineitem": "l_orderkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, "
                "l_discount double, l_tax double, l_returnflag string, l_shipdate timestamp_ntz",
    "events": "ts timestamp_ntz, event_type string, value double",
}


# Market segments of the star schema, in alphabetical order.
SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{folder}/{name}.parquet")


def observations(spark: SparkSession, folder: str) -> DataFrame:
    """One row per line item, in the fixed schema.

    Orders and line items both grow with the data, so neither is ever broadcast: the hint asks for a
    sort-merge join, which spreads over all tasks and spills. Orders find their place first, so line
    items are shuffled once, by order.
    """
    places = _table(spark, folder, "customer").join(
        _table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    ).select("c_custkey", "c_mktsegment", "n_name", "n_nationkey", "n_regionkey")
    placed = _table(spark, folder, "orders").join(places, F.col("o_custkey") == F.col("c_custkey"))
    rows = _table(spark, folder, "lineitem").join(placed.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))
    return with_date_parts(rows.select(
        F.col("n_name").alias("region"), F.col("l_shipdate").cast("date").alias("date"),
        F.when(F.col("l_returnflag") == "N", 0.0).otherwise(F.col("l_quantity")).alias("precipitations"),
        F.floor(F.col("l_discount") * 100 + 0.5).cast("double").alias("temperature_min"),
        F.floor(F.col("l_tax") * 100 + 0.5).cast("double").alias("temperature_max"),
        F.col("l_quantity").alias("humidite"), F.col("l_linenumber").alias("vent"),
        F.floor("l_extendedprice").cast("double").alias("pression"),
        F.col("n_nationkey").cast("double").alias("latitude"),
        F.col("n_regionkey").cast("double").alias("longitude"),
        F.col("n_nationkey").alias("altitude"), F.col("c_mktsegment").alias("type_sol"),
        F.col("n_regionkey").alias("distance_cote"),
    ))


def gappy_observations(spark: SparkSession, folder: str) -> DataFrame:
    """The same rows with values missing: some amounts read as not measured, some of them NaN and some NULL.

    Few rain amounts (50) and pressures (under 1 500) are missing, and many temperatures (0),
    wind (1) and soils (MACHINERY).
    """
    rows = observations(spark, folder)
    return rows.withColumns({
        "precipitations": F.nullif("precipitations", F.lit(50.0)),
        "temperature_min": F.when(F.col("temperature_min") == 0, float("nan")).otherwise(F.col("temperature_min")),
        "temperature_max": F.nullif("temperature_max", F.lit(0.0)),
        "pression": F.when(F.col("pression") >= 1500, F.col("pression")).otherwise(float("nan")),
        "vent": F.nullif("vent", F.lit(1)),
        "type_sol": F.nullif("type_sol", F.lit("MACHINERY")),
    })


def panel(spark: SparkSession, folder: str) -> DataFrame:
    """One row per region and date, with the fixed schema's columns.

    The first segment of a day is found by its place in the list, a number, so that no text makes
    Spark sort the rows.
    """
    segments = F.array(*map(F.lit, SEGMENTS))
    rows = observations(spark, folder).withColumn("_segment", F.array_position(segments, F.col("type_sol")))
    daily = rows.groupBy("region", "date").agg(
        F.sum("precipitations").alias("precipitations"),
        *[F.avg(c).alias(c) for c in ("temperature_min", "temperature_max", "humidite")],
        F.max("vent").alias("vent"), F.avg("pression").alias("pression"),
        F.max("latitude").alias("latitude"), F.max("longitude").alias("longitude"),
        F.max("altitude").alias("altitude"), F.get(segments, F.min("_segment") - 1).alias("type_sol"),
        F.max("distance_cote").alias("distance_cote"),
    )
    return with_date_parts(daily)


def event_panel(spark: SparkSession, folder: str) -> DataFrame:
    """A panel from the event stream: event type as region, summed whole values per day."""
    events = _table(spark, folder, "events")
    daily = events.groupBy(
        F.col("event_type").alias("region"), F.col("ts").cast("date").alias("date")
    ).agg(F.sum(F.floor("value")).cast("double").alias("precipitations"))
    return with_date_parts(daily)


def region_attributes(spark: SparkSession, folder: str) -> DataFrame:
    """Region dimension: one row per nation."""
    return _table(spark, folder, "nation").select(
        F.col("n_name").alias("region"), F.col("n_nationkey").cast("double").alias("latitude"),
        F.col("n_regionkey").cast("double").alias("longitude"), F.col("n_nationkey").alias("altitude"),
        F.col("n_regionkey").alias("distance_cote"),
    )
