"""Registered queries; importing this package fills the registry."""

from recordlink.plans import logs, lookups, reports, resolution, scalars, sources, streams  # noqa: F401
from recordlink.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
