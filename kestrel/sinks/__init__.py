"""Writers: delimited text, CSV, parquet, index-style partitioned tables."""
