"""Rainfall column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from rainpanel.functions.calendar import _c

# Upper bound in mm (exclusive) and label of each class; above the last, heavy rain.
RAIN_CLASSES = ((0.1, "Temps sec"), (5.0, "Pluie légère"), (20.0, "Pluie modérée"))
HEAVY_RAIN = "Forte pluie"


def known(value: Column | str) -> Column:
    """The value, with NaN read as NULL."""
    return F.nullif(_c(value).cast("double"), F.lit(float("nan")))


def rain_class(mm: Column | str) -> Column:
    """Intensity class of a daily amount; NULL and NaN stay NULL."""
    amount = known(mm)
    label = F.when(amount.isNull(), F.lit(None).cast("string"))
    for bound, name in RAIN_CLASSES:
        label = label.when(amount < bound, name)
    return label.otherwise(HEAVY_RAIN)


def at_least_zero(value: Column | str) -> Column:
    return clamp(value, low=0.0)


def clamp(value: Column | str, low: float | None = None, high: float | None = None) -> Column:
    """Limit a value to [low, high]; NULL stays NULL."""
    amount, bounded = known(value), F
    if low is not None:
        bounded = bounded.when(amount < low, float(low))
    if high is not None:
        bounded = bounded.when(amount > high, float(high))
    return amount if bounded is F else bounded.otherwise(amount)


def axis_top(mm: Column | str, deviation: Column | str) -> Column:
    """Upper axis value of a prediction chart: room for two deviations, never under 1 mm."""
    spread = F.coalesce(known(deviation), F.lit(0.0))
    return F.greatest(_c(mm) * 1.5, _c(mm) + spread * 2 + 5, F.lit(1.0))
