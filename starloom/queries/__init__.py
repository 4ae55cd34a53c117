"""Queries over the given tables."""

from starloom.queries import checks, columns, feeds, frames, layers, star  # noqa: F401  (fill the registry)
from starloom.queries.registry import REGISTRY

__all__ = ["REGISTRY"]
