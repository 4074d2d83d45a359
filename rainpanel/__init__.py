"""Daily rainfall panels on Spark: cleaning, exploration, prediction and long-term forecast."""

from rainpanel.schema import SCHEMA

__all__ = ["SCHEMA"]
