"""Queries over the given tables, one or more per operator."""

from checks import classes, encoding, learning, metrics, rows, sources, streams, windows  # noqa: F401
from checks.base import REGISTRY

__all__ = ["REGISTRY"]
