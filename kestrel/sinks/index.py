"""Index-style sink: one table per ``index/type`` resource, partitioned by batch.

Stands in for a search-index writer.  Each micro-batch overwrites only its
own ``batch_id`` partition, so a replayed batch (after a failure) replaces
rather than duplicates its documents.  An ``index/type`` has a declared schema;
documents are cast to it on write (the typed mapping).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Typed mappings of the three indices (fixed by the original deployment).
INDEX_SCHEMAS: dict[str, T.StructType] = {
    "customers/customer": T.StructType([
        T.StructField("address", T.StringType()), T.StructField("childCareCosts", T.DoubleType()),
        T.StructField("dob", T.DateType()), T.StructField("firstname", T.StringType()),
        T.StructField("housingCosts", T.DoubleType()), T.StructField("nino", T.StringType()),
        T.StructField("postcode", T.StringType()), T.StructField("surname", T.StringType()),
        T.StructField("tstamp", T.TimestampNTZType())]),
    "risks/topCentileHousingCosts": T.StructType([
        T.StructField("housingCosts", T.DoubleType()), T.StructField("nino", T.StringType()),
        T.StructField("risk_category", T.StringType()), T.StructField("tstamp", T.TimestampNTZType())]),
    "risks/topCentileChildCareCosts": T.StructType([
        T.StructField("childCareCosts", T.DoubleType()), T.StructField("nino", T.StringType()),
        T.StructField("risk_category", T.StringType()), T.StructField("tstamp", T.TimestampNTZType())]),
    "metrics/metric": T.StructType([
        T.StructField("@timestamp", T.TimestampNTZType()), T.StructField("topCentileHousingCosts", T.DoubleType())]),
}


def cast_to_index(df: DataFrame, resource: str, keep: list[str] | None = None) -> DataFrame:
    """Project ``df`` onto the declared mapping (missing fields → NULL, extra dropped)."""
    schema = INDEX_SCHEMAS.get(resource)
    if schema is None:
        return df.drop("batch_id") if keep else df
    cols = []
    for f in schema.fields:
        c = F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None)
        cols.append(c.cast(f.dataType).alias(f.name))
    return df.select(*cols, *(keep or []))


def _resource_path(root: str, resource: str) -> str:
    index, typ = resource.split("/", 1)
    return f"{root.rstrip('/')}/index={index}/type={typ}"


def write_index(df: DataFrame, root: str, resource: str, batch_id: int) -> None:
    """Write one batch of documents to ``resource``; overwrites that batch only."""
    write_index_batches(df.withColumn("batch_id", F.lit(int(batch_id))), root, resource)


def write_index_batches(df: DataFrame, root: str, resource: str, batch_col: str = "batch_id") -> None:
    """Write many batches at once; each ``batch_col`` partition present in ``df``
    is replaced (dynamic partition overwrite), others are left alone."""
    tagged = df.withColumn("_batch", F.col(batch_col).cast("long"))
    docs = cast_to_index(tagged, resource, keep=["_batch"]).withColumnRenamed("_batch", "batch_id")
    (docs.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("batch_id").parquet(_resource_path(root, resource)))


def read_index(spark: SparkSession, root: str, resource: str) -> DataFrame:
    """All documents of ``resource`` (with their ``batch_id``)."""
    return spark.read.option("basePath", _resource_path(root, resource)).parquet(_resource_path(root, resource))


def index_writer(root: str, resource: str):
    """A ``foreachBatch`` function writing each micro-batch to ``resource``."""
    def _write(batch: DataFrame, batch_id: int) -> None:
        write_index(batch, root, resource, batch_id)
    return _write
