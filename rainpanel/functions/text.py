"""Text layout of results."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from rainpanel.functions.calendar import KEY_FORMAT, _c


def file_key(name: Column | str) -> Column:
    """A name usable inside a file name."""
    return F.replace(_c(name), F.lit(" "), F.lit("_"))


def report_key(region: Column | str, date: Column | str) -> Column:
    """Key of one prediction report: region and day."""
    return F.concat_ws("_", F.lit("prediction"), file_key(region), F.date_format(_c(date), KEY_FORMAT))


def fixed(value: Column | str, digits: int = 2) -> Column:
    """Number as text with a fixed count of decimals, rounded half up."""
    return F.format_string(f"%.{digits}f", F.round(_c(value), digits))


def table_line(region: Column | str, mm: Column | str, category: Column | str) -> Column:
    """One line of the printed summary: name, amount and class in fixed-width fields."""
    return F.format_string("%-15s %-20s %-15s", _c(region), fixed(mm), _c(category))
