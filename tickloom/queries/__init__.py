"""Every registered query with its oracle SQL."""

from __future__ import annotations

from tickloom.queries import (  # noqa: F401  (importing a module registers its queries)
    drift,
    features,
    flows,
    forecast,
    governance,
    ingest,
    jobs,
    models,
    monitoring,
    quality,
    reports,
    selection,
    streams,
)
from tickloom.queries.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
