"""Typed source tables, readers and sinks."""

from annuity.sources.tables import SourceTables, read_minimum_fees
from annuity.sources.testdata import fixture_tables

__all__ = ["SourceTables", "fixture_tables", "read_minimum_fees"]
