"""Operators on observation panels. Every one takes DataFrames and returns a DataFrame."""

from rainpanel.operators import climatology, explore, features, forecast, joins, models, quality, windows

__all__ = ["climatology", "explore", "features", "forecast", "joins", "models", "quality", "windows"]
