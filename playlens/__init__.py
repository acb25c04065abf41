"""playlens: playback-log analytics as Spark DataFrame operators.

Layout
------
sources/    readers and writers: parquet tables, JSON log envelopes, CSV
            dimensions and state tables, the incremental pull
functions/  column expressions (title extraction, time ranges, genre strings)
operators/  DataFrame -> DataFrame building blocks (filters, joins, aggregates,
            ranking, FP-Growth rules)
plans/      the user-level pipelines: view statistics and recommendations
streaming/  Structured Streaming jobs and their state tables
"""

__all__ = ["session", "params", "schemas"]
