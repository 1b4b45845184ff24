"""Geo-tagged short documents ("tweets") derived from the documents table,
and their page files (one JSON array per page, as a search API returns them)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel.operators.sequence import row_index
from kestrel.sources.tables import table

TWEET_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("created_at", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("place", T.StructType([T.StructField("bounding_box", T.StructType([
        T.StructField("coordinates", T.ArrayType(T.ArrayType(T.ArrayType(T.DoubleType()))))]))])),
    T.StructField("user", T.StructType([T.StructField("id", T.LongType())])),
])

TWITTER_TIME = "EEE MMM dd HH:mm:ss '+0000' yyyy"


def tweet_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested tweet documents: one per document row."""
    d = table(spark, sf_dir, "documents")
    created = F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(mins=(F.col("doc_id") * 7).cast("int"))
    lat = F.lit(51.3) + (F.col("doc_id") % 83).cast("double") / 100.0
    lon = F.lit(-0.6) + (F.col("doc_id") % 89).cast("double") / 100.0
    ring = F.array(F.array(lon - 0.01, lat - 0.01), F.array(lon + 0.01, lat - 0.01),
                   F.array(lon + 0.01, lat + 0.01), F.array(lon - 0.01, lat + 0.01))
    return d.select(
        F.col("doc_id").alias("id"), F.date_format(created, TWITTER_TIME).alias("created_at"), "text",
        F.struct(F.struct(F.array(ring).alias("coordinates")).alias("bounding_box")).alias("place"),
        F.struct((F.col("doc_id") % 97).alias("id")).alias("user"))


def write_pages(tweets: DataFrame, path: str, page_size: int = 100, one_file_per_page: bool = False) -> None:
    """Write pages ``[p*size, (p+1)*size]`` (bounds inclusive, so boundary ids repeat).

    Each page is one JSON array of at most ``page_size + 1`` documents.  By
    default pages are packed one per line into ordinary-sized files;
    ``one_file_per_page`` reproduces the original one-array-per-file layout
    (fine for a few pages, not for billions).
    """
    p = F.floor(F.col("id") / page_size)
    pages = F.when((F.col("id") % page_size == 0) & (F.col("id") > 0), F.array(p, p - 1)).otherwise(F.array(p))
    exploded = tweets.withColumn("page", F.explode(pages))
    per_page = exploded.groupBy("page").agg(
        F.to_json(F.sort_array(F.collect_list(F.struct(*tweets.columns)), asc=False)).alias("value"))
    if one_file_per_page:
        per_page.write.mode("overwrite").partitionBy("page").text(path)
    else:
        per_page.select("value").write.mode("overwrite").text(path)


def read_pages(spark: SparkSession, path: str, one_file_per_page: bool = False) -> DataFrame:
    """All pages; every top-level JSON array (per line, or per file) is exploded into rows."""
    return spark.read.schema(TWEET_SCHEMA).option("multiLine", one_file_per_page).json(path)


def flatten(tweets: DataFrame) -> DataFrame:
    """id, date, text (newlines → spaces), first ring of the bounding box, user id."""
    return tweets.select(
        "id", F.col("created_at").alias("date"), F.replace(F.col("text"), F.lit("\n"), F.lit(" ")).alias("text"),
        F.element_at("place.bounding_box.coordinates", 1).alias("bounding_box"),
        F.col("user.id").alias("user"))


def keyset_pages(df: DataFrame, id_col: str, size: int, ids_per_bucket: int = 100_000) -> DataFrame:
    """``page, n, next_max_id, max_id`` of pages of ``size`` ids, newest (largest) first.

    The cursor is inclusive: a page starts with the smallest id of the page
    before.  Positions come from per-bucket row numbers plus the sizes of the
    buckets ahead, so no task sorts the whole result.
    """
    keyed = df.select(F.lit(0).alias("_all"), (-F.col(id_col)).alias("_order"),
                      F.floor(-F.col(id_col) / ids_per_bucket).alias("_bucket"), F.col(id_col).alias("_id"))
    at = F.col("pos")
    page = F.floor(at / (size - 1)).cast("long")
    pages = F.when((at > 0) & (at % (size - 1) == 0), F.array(page, page - 1)).otherwise(F.array(page))
    ranked = row_index(keyed, "_all", ["_order"], bucket="_bucket", name="pos")
    return (ranked.select("_id", F.explode(pages).alias("page")).groupBy("page")
            .agg(F.count("*").alias("n"), F.min("_id").alias("next_max_id"), F.max("_id").alias("max_id")))
