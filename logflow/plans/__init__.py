"""Every registered query and its SQL check."""

from logflow.plans import analytics, scans, sinks, streams, values  # noqa: F401
from logflow.plans.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
