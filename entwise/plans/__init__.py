"""Query catalogue (Spark), DuckDB oracle texts and end-to-end jobs."""
