"""Event-stream processing as Spark jobs: decode, enrich, route, land, ingest,
curate, repair, archive and audit.

Every operator maps a DataFrame to a DataFrame with built-in expressions, so it
runs unchanged in a batch job and inside a Structured Streaming micro-batch.
"""
