"""Runnable queries by topic.  Importing this package registers all of them."""

from lithosense.registry import boosted, fits, ingest, prep, reports, rollups, sections, streams, tables  # noqa: F401
from lithosense.registry.base import ORACLES, QUERIES  # noqa: F401
