"""Oracle SQL and the local Spark-vs-DuckDB comparison."""
