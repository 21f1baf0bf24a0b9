"""Every operator as a query over the standard tables."""

from millrace.queries import aggregates, filters, joins, maps, quality, scalars, sinks, sources, streams, vectors
from millrace.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "aggregates", "filters", "joins", "maps", "quality", "scalars", "sinks", "sources",
           "streams", "vectors"]
