"""The registered queries."""

from . import declared, flows, metrics, pages, sessions, streams, training
from .registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL", "declared", "flows", "metrics", "pages", "sessions", "streams", "training"]
