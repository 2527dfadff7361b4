"""All registered queries."""

from __future__ import annotations

from . import align, audio, catalog, crossquery, events, lang, optical, prep, profile, quality, spectral  # noqa: F401
from .registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
