"""All registered queries and their oracles."""

from tidewell.plans import operations, streams, telemetry
from tidewell.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "operations", "streams", "telemetry"]
