"""All registered queries of the seat-auction domain."""

from seatloom.plans import analytics, entities, ingest, integrity, market, similar, statistics, storage, texts, training  # noqa: F401  registering
from seatloom.plans.registry import FLAGSHIP, ORACLES, QUERIES

__all__ = ["FLAGSHIP", "ORACLES", "QUERIES"]
