"""Registered queries (one module per area) and their DuckDB oracles."""

from smelter.plans import (  # noqa: F401  (each module registers its queries)
    exploration, ingest, lookups, market, medallion, modeling, profiling, semantic, versions)
from smelter.plans.registry import OPERATORS, ORACLES, QUERIES  # noqa: F401
