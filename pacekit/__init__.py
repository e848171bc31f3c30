"""pacekit: race-results analytics expressed as Spark DataFrame / SQL jobs.

Sub-packages
------------
functions  Column -> Column helpers (parsing, text keys, fuzzy scores, formats)
sources    table loaders, adapters from the driver tables, file ingest, warehouse sinks
operators  reusable DataFrame -> DataFrame operators (windows, dedup, matching, shredding)
plans      composed jobs and report queries (features, reports, profiling, model, scoring)
streaming  incremental ingest with Structured Streaming
"""

__version__ = "0.1.0"
