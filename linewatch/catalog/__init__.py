"""One query per operator over the test tables, with its SQL twin where SQL can
say the same."""

from linewatch.catalog import features, models, projections, sources, statistics, windows
from linewatch.catalog.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "features", "models", "projections", "sources", "statistics", "windows"]
