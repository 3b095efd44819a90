"""Named queries over the test tables, each with its SQL oracle where one exists."""

from tillsight.catalog import (  # noqa: F401
    aggregate,
    cleaning,
    derive,
    evaluate,
    explore,
    files,
    joining,
    models,
    quality,
    routing,
    splitting,
)
from tillsight.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
