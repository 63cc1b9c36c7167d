"""Python workers of a session someone else built."""

from __future__ import annotations

from tidemark.session import importable

__all__ = ["importable"]
