"""Lineage analytics for streaming platforms, expressed as Spark jobs.

Landed inventories (connectors, SQL statements, persistent queries, metric rows,
table syncs, topic metadata, schemas) become one edge table, one run event per
job, and a change feed against the previously known state.
"""

__version__ = "0.1.0"
