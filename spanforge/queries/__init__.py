"""Queries over the driver's tables, each with its DuckDB oracle. Importing the modules registers them."""

from . import classes, grids, review, signals  # noqa: F401
