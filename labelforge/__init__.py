"""labelforge: entity tagging and profile analytics expressed as Spark DataFrame jobs.

Sub-packages
------------
sources    readers and sinks (wide string tables, conditions, catalog, TSV/CSV, cells, tables)
functions  Column-level helpers (rule text parsing, dates, score tables, casts)
operators  DataFrame -> DataFrame tag operators (match, range, recency, mode, top-k, profile, ML)
plans      tag models and jobs composed from the operators, plus the query catalogue
streaming  the same ingest and tag operators driven by Structured Streaming micro-batches

Every function takes and returns DataFrames and performs no action, except sinks,
ML ``fit`` calls and the tiny driver-side size checks that guard broadcasts.
"""

__version__ = "0.1.0"
