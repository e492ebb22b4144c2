"""Queries over the driver's tables; importing this package registers all of them."""

from . import (
    cleaning_queries,
    evaluation_queries,
    external_queries,
    grid_queries,
    model_queries,
    source_queries,
)
from .registry import QUERIES, TWINS

__all__ = [
    "QUERIES",
    "TWINS",
    "cleaning_queries",
    "evaluation_queries",
    "external_queries",
    "grid_queries",
    "model_queries",
    "source_queries",
]
