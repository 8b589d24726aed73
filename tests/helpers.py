"""Small frames and plan inspection for tests."""

from __future__ import annotations

from collections import Counter


def bag(frame, columns=None) -> Counter:
    columns = sorted(columns or frame.columns)
    return Counter(tuple(row) for row in frame.select(*columns).collect())


def plan(frame) -> str:
    return frame._jdf.queryExecution().toString()


def executed(frame) -> str:
    """Plan after adaptive execution."""
    frame.collect()
    return frame._jdf.queryExecution().executedPlan().toString()
