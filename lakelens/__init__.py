"""lakelens: image-lake and geospatial data jobs written as PySpark DataFrame plans.

Subpackages
-----------
functions  Column-level building blocks (hashing, paths, JSON, time, geo).
sources    Readers: image folders, message topics, lake tables, driver-table fixtures.
sinks      Writers: topic envelopes, object store, first-wins tables, lake appends.
operators  Set-based operators (ingest, metadata, processed stream, change log, spatial).
plans      Ready-made query plans and the batch ingest job.
streaming  Structured Streaming forms of ingest and processing.
"""

__version__ = "0.1.0"
