"""All registered queries."""

from marketgrain.queries import drift, features, models, quality, reports, service, storage, streams  # noqa: F401
from marketgrain.queries.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
