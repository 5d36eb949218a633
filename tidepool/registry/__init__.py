"""Registered queries: every operator over the given tables, with equivalent SQL."""

from tidepool.registry import aggregates, landing, market, numbers, ordered, streams

MODULES = (numbers, aggregates, ordered, market, landing, streams)


def registered() -> dict:
    """name -> (query, sql or None)"""
    merged: dict = {}
    for module in MODULES:
        overlap = merged.keys() & module.QUERIES.keys()
        if overlap:
            raise ValueError(f"registered twice: {sorted(overlap)}")
        merged |= module.QUERIES
    return merged
