"""Calendar column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

# Season labels, first and last rainy month.
RAINY_SEASON, DRY_SEASON = "saison_pluies", "saison_seche"
RAINY_FIRST_MONTH, RAINY_LAST_MONTH = 6, 10

# Month labels used in reports.
MONTH_LABELS = ("Jan", "Fév", "Mar", "Avr", "Mai", "Juin", "Juil", "Août", "Sep", "Oct", "Nov", "Déc")

# Date layouts for people, for file keys and for CSV.
DISPLAY_FORMAT, KEY_FORMAT, ISO_FORMAT = "dd/MM/yyyy", "yyyyMMdd", "yyyy-MM-dd"

DAYS_PER_YEAR = 365.25


def _c(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def season(month: Column | str) -> Column:
    return F.when(
        _c(month).between(RAINY_FIRST_MONTH, RAINY_LAST_MONTH), RAINY_SEASON
    ).otherwise(DRY_SEASON)


def month_label(month: Column | str) -> Column:
    labels = F.array(*[F.lit(label) for label in MONTH_LABELS])
    return F.get(labels, _c(month) - 1)


def month_start(date: Column | str) -> Column:
    return F.trunc(_c(date), "month")


def month_date(year: Column | str, month: Column | str) -> Column:
    """First day of the month named by a year and a month number."""
    return F.make_date(_c(year), _c(month), F.lit(1))


def month_index(date: Column | str) -> Column:
    """Months since year 0: a running number that grows by one per month."""
    return F.year(_c(date)) * 12 + F.month(_c(date)) - 1


def parse_date(text: Column | str, pattern: str = ISO_FORMAT, strict: bool = False) -> Column:
    """Text to date; unreadable text gives NULL, or an error when ``strict``."""
    return F.to_date(_c(text), pattern) if strict else F.try_to_date(_c(text), pattern)


def target_date(text: Column | str, reference: Column | str, days: int = 1) -> Column:
    """Date asked for: the text when it is a valid date, else ``days`` after ``reference``."""
    return F.coalesce(F.try_to_date(_c(text), "yyyy-M-d"), F.date_add(_c(reference), days))


def date_text(date: Column | str, pattern: str = DISPLAY_FORMAT) -> Column:
    return F.date_format(_c(date), pattern)


def cyclic_day(date: Column | str) -> tuple[Column, Column]:
    """Sine and cosine of the position in the year, so 31 December is next to 1 January."""
    angle = F.dayofyear(_c(date)) * F.lit(2 * math.pi / DAYS_PER_YEAR)
    return F.sin(angle), F.cos(angle)


def cyclic_month(month: Column | str) -> tuple[Column, Column]:
    angle = _c(month) * F.lit(2 * math.pi / 12)
    return F.sin(angle), F.cos(angle)
