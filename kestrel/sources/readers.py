"""Typed file readers (every reader takes an explicit schema unless inference is the point)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RATING_SCHEMA = T.StructType([
    T.StructField("user", T.IntegerType()), T.StructField("item", T.IntegerType()),
    T.StructField("rating", T.DoubleType()), T.StructField("ts", T.LongType())])

CATALOG_SCHEMA = T.StructType([T.StructField("item", T.IntegerType()), T.StructField("title", T.StringType())])


def _delimited(spark: SparkSession, schema, sep: str, header: bool = False, quote: str | None = ""):
    r = spark.read.schema(schema).option("sep", sep).option("header", header).option("mode", "PERMISSIVE")
    if quote is not None:
        r = r.option("quote", quote)   # "" turns quoting off: titles may hold quotes
    return r


def read_ratings(spark: SparkSession, path: str, sep: str = "::") -> DataFrame:
    """``user::item::rating::ts`` lines → typed rows plus ``bucket = ts % 10``."""
    df = _delimited(spark, RATING_SCHEMA, sep).csv(path)
    return df.withColumn("bucket", F.pmod(F.col("ts"), F.lit(10)).cast("int"))


def read_catalog(spark: SparkSession, path: str, sep: str = "::") -> DataFrame:
    """``item<sep>title`` lines (``::`` or TAB)."""
    return _delimited(spark, CATALOG_SCHEMA, sep).csv(path)


def read_header_csv(spark: SparkSession, path: str, schema, sep: str = ",") -> DataFrame:
    """Delimited file(s) whose first line is a header (dropped once per file)."""
    return _delimited(spark, schema, sep, header=True, quote=None).csv(path)


def read_dsv_infer(spark: SparkSession, path: str, sep: str = "¦") -> DataFrame:
    """Header + inferred schema + arbitrary (non-ASCII) delimiter."""
    return spark.read.option("sep", sep).option("header", True).option("inferSchema", True).csv(path)


def read_json_lines(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).json(path)


def read_quoted_csv(spark: SparkSession, path: str, schema, sep: str = ",", quote: str = '"',
                    header: bool = True) -> DataFrame:
    """CSV with a configurable delimiter *and* quote character (e.g. ``|``)."""
    return _delimited(spark, schema, sep, header=header, quote=quote).csv(path)


class MissingInput(RuntimeError):
    pass


def load_personal_ratings(spark: SparkSession, path: str, sep: str = "::") -> DataFrame:
    """A user's own ratings: keep ``rating > 0``; fail when the file is missing or empty."""
    try:
        df = read_ratings(spark, path, sep)
        df.schema  # resolve the path now
    except Exception as e:  # AnalysisException: path does not exist
        raise MissingInput(f"ratings file {path} does not exist") from e
    df = df.where(F.col("rating") > 0).drop("bucket")
    if df.isEmpty():
        raise MissingInput(f"no ratings provided in {path}")
    return df
