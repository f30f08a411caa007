"""Named queries over the driver's tables, with independent SQL answers."""

from glyphatlas.catalog import annotating, graphs, ingest, mapping, selecting  # noqa: F401  (they register themselves)
from glyphatlas.catalog.registry import ANSWERS, QUERIES

__all__ = ["ANSWERS", "QUERIES"]
