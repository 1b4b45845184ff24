"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator,
plus the equivalent SQL text for the DuckDB oracle where one exists."""
