"""All registered queries."""

from __future__ import annotations

from cinderlake.catalog import analysis_queries, cleaning_queries, dashboard_queries, perimeter_queries, place_queries, source_queries


def all_queries() -> dict:
    """Query name -> (function of (spark, sf_dir), check SQL or None)."""
    out: dict = {}
    for module in (dashboard_queries, cleaning_queries, place_queries, perimeter_queries, analysis_queries, source_queries):
        clash = out.keys() & module.QUERIES.keys()
        if clash:
            raise ValueError(f"query names registered twice: {sorted(clash)}")
        out.update(module.QUERIES)
    return out
