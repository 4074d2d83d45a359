"""All registered queries."""

from checks import cleaning, exploring, forecasting, functions, modelling, predicting, tables  # noqa: F401
from checks.common import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
