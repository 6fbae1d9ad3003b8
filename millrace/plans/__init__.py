"""Named queries over the driver tables, each with the SQL that gives the same rows."""

from millrace.plans.registry import ORACLES, QUERIES

from millrace.plans import (  # noqa: E402,F401  (registration)
    aggregates,
    conversions,
    files_and_sinks,
    messages,
    registry_messages,
    round_trips,
)

__all__ = ["ORACLES", "QUERIES"]
