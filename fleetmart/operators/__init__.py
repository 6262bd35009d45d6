"""DataFrame -> DataFrame operators: ingest, dedup, merge, history, quality, sinks."""
