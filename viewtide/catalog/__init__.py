"""All registered queries."""

from viewtide.catalog import checks, model, patterns, reporting, storage, streams  # noqa: F401
from viewtide.catalog.registry import QUERIES

__all__ = ["QUERIES"]
