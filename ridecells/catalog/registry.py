"""All named queries."""

from ridecells.catalog import models, scalars, streams, tables

PARTS = (scalars, tables, streams, models)


def all_queries():
    """Name to (query, SQL or None)."""
    found = {}
    for part in PARTS:
        for name, query, sql in part.QUERIES:
            if name in found:
                raise ValueError(f"two queries are named {name}")
            found[name] = (query, sql)
    return found
