"""Aggregates from text specs, reports, shape changes, sinks and job checks."""
