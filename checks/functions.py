"""Scalar functions over the panel (F)."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.common import OBS, PANEL, check, rd, rounded
from rainpanel import functions as fn
from rainpanel.operators import features
from rainpanel.plans import star


def over_panel(columns):
    """Query of panel columns; the expressions are made when it runs, as they need a session."""
    return lambda spark, sf: rounded(star.panel(spark, sf).select("region", "date", *columns()))


def sql(select: str) -> str:
    return f"WITH {PANEL} SELECT region, date, {select} FROM panel"


SEASON = "CASE WHEN mois BETWEEN 6 AND 10 THEN 'saison_pluies' ELSE 'saison_seche' END"


def classes(value: str) -> str:
    return (f"CASE WHEN {value} IS NULL THEN NULL WHEN {value} < 0.1 THEN 'Temps sec' WHEN {value} < 5 THEN 'Pluie légère' "
            f"WHEN {value} < 20 THEN 'Pluie modérée' ELSE 'Forte pluie' END")


check("f1_day_of_year", sql("CAST(dayofyear(date) AS INTEGER) AS jour_annee"))(over_panel(lambda: [F.dayofyear("date").alias("jour_annee")]))
check("f2_season", sql(f"{SEASON} AS saison"))(over_panel(lambda: [fn.season("mois").alias("saison")]))
check("f3_quarter", sql("CAST(quarter(date) AS INTEGER) AS trimestre"))(over_panel(lambda: [F.quarter("date").alias("trimestre")]))
check("f4_rain_class", sql(f"{rd('precipitations')} AS precipitations, {classes('precipitations')} AS category"))(
    over_panel(lambda: ["precipitations", fn.rain_class("precipitations").alias("category")]))
check("f5_date_text", sql(
    "strftime(date, '%d/%m/%Y') AS shown, strftime(date, '%Y%m%d') AS key, strftime(date, '%Y-%m-%d') AS iso"))(
    over_panel(lambda: [fn.date_text("date").alias("shown"), fn.date_text("date", "yyyyMMdd").alias("key"),
               fn.date_text("date", "yyyy-MM-dd").alias("iso")]))


@check("f6_target_date", f"""
WITH {OBS} SELECT region, type_sol AS given,
  coalesce(TRY_CAST(CASE WHEN type_sol = 'BUILDING' THEN strftime(date, '%Y-%m-%d') ELSE type_sol END AS DATE),
    CAST(date + INTERVAL 3 DAY AS DATE)) AS target
FROM obs""")
def target_date(spark, sf):
    text = F.when(F.col("type_sol") == "BUILDING", F.date_format("date", "yyyy-MM-dd")).otherwise(F.col("type_sol"))
    rows = star.observations(spark, sf).withColumn("text", text)
    return rows.select("region", F.col("type_sol").alias("given"), fn.target_date("text", "date", 3).alias("target"))


check("f7_date_parts", sql(
    "CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month, CAST(day(date) AS INTEGER) AS day, "
    "CAST(date_trunc('month', date) AS DATE) AS month_start, CAST(year(date) * 12 + month(date) - 1 AS INTEGER) AS month_index"))(
    over_panel(lambda: [F.year("date").alias("year"), F.month("date").alias("month"), F.dayofmonth("date").alias("day"),
               fn.month_start("date").alias("month_start"), fn.month_index("date").alias("month_index")]))
check("f8_month_label", sql(
    "['Jan', 'Fév', 'Mar', 'Avr', 'Mai', 'Juin', 'Juil', 'Août', 'Sep', 'Oct', 'Nov', 'Déc'][mois] AS label"))(
    over_panel(lambda: [fn.month_label("mois").alias("label")]))
check("f9_at_least_zero", sql(f"{rd('greatest(0.0, precipitations - humidite)')} AS amount"))(
    over_panel(lambda: [fn.at_least_zero(F.col("precipitations") - F.col("humidite")).alias("amount")]))
check("f10_clamp", sql(f"{rd('greatest(5.0, least(40.0, precipitations))')} AS amount"))(
    over_panel(lambda: [fn.clamp("precipitations", 5, 40).alias("amount")]))
check("f11_fixed_decimals", sql(
    "printf('%.2f', round(humidite, 2)) AS two, printf('%.1f', round(pression, 1)) AS one, "
    f"printf('%-15s %-20s %-15s', region, printf('%.2f', round(humidite, 2)), {classes('humidite')}) AS line"))(
    over_panel(lambda: [fn.fixed("humidite").alias("two"), fn.fixed("pression", 1).alias("one"),
               fn.table_line("region", "humidite", fn.rain_class("humidite")).alias("line")]))


@check("f12_file_key", f"""
WITH {OBS} SELECT region, date, replace(region || ' ' || type_sol, ' ', '_') AS file_key,
  'prediction_' || replace(region, ' ', '_') || '_' || strftime(date, '%Y%m%d') AS report_key FROM obs""")
def file_key(spark, sf):
    return star.observations(spark, sf).select(
        "region", "date", fn.file_key(F.concat_ws(" ", "region", "type_sol")).alias("file_key"),
        fn.report_key("region", "date").alias("report_key"))


@check("f13_cyclic", sql(
    f"{rd('sin(2 * pi() * dayofyear(date) / 365.25)')} AS jour_sin, {rd('cos(2 * pi() * dayofyear(date) / 365.25)')} AS jour_cos, "
    f"{rd('sin(2 * pi() * mois / 12)')} AS mois_sin, {rd('cos(2 * pi() * mois / 12)')} AS mois_cos"))
def cyclic(spark, sf):
    return rounded(features.add_cyclic_features(star.panel(spark, sf)).select(
        "region", "date", "jour_sin", "jour_cos", "mois_sin", "mois_cos"))


check("f14_parse_date", sql("date AS parsed, make_date(annee, mois, 1) AS first_day, NULL::DATE AS unreadable"))(
    over_panel(lambda: [fn.parse_date(F.date_format("date", "yyyy-MM-dd")).alias("parsed"),
               fn.month_date("annee", "mois").alias("first_day"), fn.parse_date("type_sol").alias("unreadable")]))
