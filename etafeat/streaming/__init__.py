"""Structured Streaming entry points.

The pipeline has no unbounded source; the one incremental pattern is appending
batches of rows (orders, route-hour chunks) to a table as they arrive. That is
``append_stream``: a file-source stream into an append-only Parquet sink with a
checkpoint, run as ``availableNow`` so it processes what is there and stops.
"""

from etafeat.streaming.append import append_stream  # noqa: F401
