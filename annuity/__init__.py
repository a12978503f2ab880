"""Renewal-fee settlement analytics as lazy Spark DataFrame operators.

Layers:
  sources/    typed source tables (catalog, CSV, test fixtures) and sinks
  functions/  column-expression helpers (dates, money fields, fixed-width)
  operators/  extracts, merges, business rules, reports, exchange records
  plans/      the composed job and the registry of named queries
  streaming/  nothing: the settlement job is a periodic batch
"""

from annuity.config import RunConfig, reporting_period

__all__ = ["RunConfig", "reporting_period"]
