"""All registered queries; importing the modules fills the registry."""

from . import (  # noqa: F401
    aggregates,
    files,
    joins,
    late,
    plans,
    rows,
    star,
    streams,
    tables,
    windows,
)
from .registry import REGISTRY, Query

__all__ = ["REGISTRY", "Query"]
