"""Readers, writers and the driver test-data views."""

from urbanlens.sources import readers, sinks, testdata

__all__ = ["readers", "sinks", "testdata"]
