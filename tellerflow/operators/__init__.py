"""Reusable data operators: history, as-of resolution, activity, ranking, sinks, checks."""
