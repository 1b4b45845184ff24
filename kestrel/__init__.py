"""kestrel — Spark-native telematics, recommendation and stream analytics.

Every job is a DataFrame / Spark SQL / Structured Streaming / pyspark.ml plan.
Sub-packages:

* ``functions``  – column-expression helpers (geo, datetime, strings)
* ``sources``    – typed readers for text, delimited, JSON, XML, parquet, streams
* ``sinks``      – file and index-style writers
* ``operators``  – relational building blocks (mileage, top-k, stats, splits ...)
* ``streaming``  – Structured Streaming jobs (word counts, risk flags, scoring)
* ``ml``         – ALS recommender and churn classifier jobs
* ``plans``      – the registered queries (one per operator) and their SQL oracles
"""

__version__ = "0.1.0"
