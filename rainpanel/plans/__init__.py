"""Jobs that chain operators, and the adapter that makes panels from star-schema tables."""

from rainpanel.plans import jobs, star

__all__ = ["jobs", "star"]
