"""tidemark: OHLCV bar analytics expressed as Spark DataFrame plans.

Sub-packages
------------
sources    reading/writing tables, bar aggregation, CSV and JSON messages, keyed store
functions  column expressions (price change, rounding, coercion, lookups)
operators  window enrichment, validation, profiling, keyed mutation, analysis, rollups
plans      the named query catalog and the matching DuckDB oracle SQL
streaming  Structured Streaming decode / stateful enrichment / sinks
"""

__version__ = "0.1.0"
