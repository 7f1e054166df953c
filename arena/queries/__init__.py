"""Registered queries: library operators bound to the driver tables, with their SQL."""

from arena.queries import baskets, ingest, legality, metrics, normalise, pages, quality, refresh, resolve  # noqa: F401
