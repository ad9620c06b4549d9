"""Query catalogue: importing this package registers every query."""

from sparkfold.plans import formats, genomics, graph, logs, mapping, rejects, streams, variants  # noqa: F401
from sparkfold.plans.registry import REGISTRY, Entry, query, table

__all__ = ["REGISTRY", "Entry", "query", "table"]
