"""Every registered query."""

# Importing a module registers its queries.
from tidewell.queries import cdc, decoding, health, ledgers, loads, metadata, streams, upkeep  # noqa: F401
from tidewell.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
