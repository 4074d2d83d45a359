"""Column expressions: calendar, rainfall and text layout."""

from rainpanel.functions.calendar import (
    MONTH_LABELS, cyclic_day, cyclic_month, date_text, month_date, month_index, month_label,
    month_start, parse_date, season, target_date,
)
from rainpanel.functions.rain import at_least_zero, axis_top, clamp, known, rain_class
from rainpanel.functions.text import file_key, fixed, report_key, table_line

__all__ = [
    "MONTH_LABELS", "at_least_zero", "axis_top", "clamp", "cyclic_day", "cyclic_month", "date_text",
    "file_key", "fixed", "known", "month_date", "month_index", "month_label", "month_start",
    "parse_date", "rain_class", "report_key", "season", "table_line", "target_date",
]
