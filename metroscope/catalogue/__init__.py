"""The operators run on the benchmark tables, each beside an independent SQL statement."""

from . import (  # noqa: F401
    archives,
    cleaning,
    context,
    feeds,
    flows,
    incremental,
    positions,
    scoring,
    shapes,
    snapshots,
    stops,
    streams,
    timing,
)
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
