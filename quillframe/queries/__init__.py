"""Registered queries with their SQL twins, one module per operator family."""

from . import (  # noqa: F401  (importing registers the queries)
    aggregates,
    categories,
    experiments,
    joined,
    keyed,
    missing,
    ordering,
    projections,
    reshaping,
    sources,
    texts,
    times,
)
from .registry import REGISTRY, Query, Tables

__all__ = ["REGISTRY", "Query", "Tables"]
