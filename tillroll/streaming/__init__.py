"""Incremental delivery of the bronze ingest (no new operators)."""

from tillroll.streaming.landing import ingest_incrementally  # noqa: F401
