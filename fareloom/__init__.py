"""Trip analytics on Spark: typed ingestion, conforming, insert-only merging and reports."""
