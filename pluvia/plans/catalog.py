"""All queries of the operators outside pluvia.llm."""

from pluvia.plans import catalog_agg, catalog_events, catalog_geo, catalog_io, catalog_stats, catalog_tidy  # noqa: F401  they register on import
from pluvia.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
