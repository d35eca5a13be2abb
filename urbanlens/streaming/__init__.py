"""Incremental (Structured Streaming) form of the trip-cleaning job.

Monthly trip files land in a folder; instead of re-cleaning the whole history,
a file stream picks up only new files, applies the same row-level cleaning as
the batch job (filter + constant imputation — stateless, so no watermark or
state store is needed) and appends to a Parquet sink. The checkpoint folder
plus the file sink's commit log make the output exactly-once across restarts
and executor loss.
"""

from urbanlens.streaming.trips import clean_trips_stream, start_clean_trips

__all__ = ["clean_trips_stream", "start_clean_trips"]
