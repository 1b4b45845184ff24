"""Streaming operators.  Every function takes and returns DataFrames and works the
same on a batch DataFrame and on a streaming one (the tests compare both)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.functions.parse import split_literal
from kestrel.streaming.runner import event_time, ntz

# Block-listed words of the word-count job (fixed values).
BLOCKLIST = ["a", "b", "c"]


def words(lines: DataFrame, sep: str = " ", keep: tuple = ()) -> DataFrame:
    """One row per token of ``text`` split on a literal separator (empty tokens kept)."""
    return lines.select(*keep, F.explode(split_literal("text", sep)).alias("word"))


def tumbling_word_count(lines: DataFrame, window: str, watermark: str, sep: str = " ") -> DataFrame:
    """Per-window word counts (the "per micro-batch" count, restated on event time)."""
    w = words(lines.withColumn("et", event_time("ts")), sep, keep=("et",))
    return (w.withWatermark("et", watermark).groupBy(F.window("et", window), "word").count()
            .select(ntz("window.start").alias("window_start"), "word", "count"))


def running_word_count(lines: DataFrame, sep: str = ",") -> DataFrame:
    """Running total per word since the stream began (``updateStateByKey`` of a sum)."""
    return words(lines, sep).groupBy("word").count()


def parse_rating_messages(values: DataFrame) -> DataFrame:
    """``tstamp,user,item,rating`` lines → typed rows (malformed fields → NULL)."""
    p = split_literal("value", ",")
    return values.select(
        F.try_to_timestamp(F.try_element_at(p, F.lit(1)), F.lit("yyyy-MM-dd HH:mm:ss.SSSSSS"))
        .cast("timestamp_ntz").alias("tstamp"),
        F.try_element_at(p, F.lit(2)).try_cast("int").alias("user"),
        F.try_element_at(p, F.lit(3)).try_cast("int").alias("item"),
        F.try_element_at(p, F.lit(4)).try_cast("double").alias("rating"))


def score(ratings: DataFrame, model_items: DataFrame) -> DataFrame:
    """Stream-static join with an item-level model; prediction rounded to 0.1 as published.

    Unknown items drop (cold start), which is what the inner pair join did.
    """
    j = ratings.join(model_items, "item")
    return j.withColumn("prediction", F.round("prediction", 1))


def error_docs(scored: DataFrame, catalog: DataFrame) -> DataFrame:
    """Scored-rating documents with title, absolute, signed and squared error."""
    j = scored.join(catalog, "item")
    d = F.col("prediction") - F.col("rating")
    return j.select("tstamp", F.col("user").alias("userID"), F.col("item").alias("movieID"),
                    F.col("title").alias("movieTitle"), F.col("prediction").alias("predictedRating"),
                    F.col("rating").alias("actualRating"), F.abs(d).alias("absError"),
                    d.alias("absoluteError"), F.pow(d, 2).alias("squareError"))


def windowed_error(scored: DataFrame, window: str, watermark: str) -> DataFrame:
    """Per window: count, MSE, RMSE and the RMSE of the window-mean predictor."""
    s = scored.withColumn("et", event_time("tstamp")).withWatermark("et", watermark)
    se = F.pow(F.col("prediction") - F.col("rating"), 2)
    return (s.groupBy(F.window("et", window))
            .agg(F.count("*").alias("n"), F.avg(se).alias("mse"), F.sqrt(F.avg(se)).alias("rmse"),
                 F.stddev_pop("rating").alias("baseline_rmse"))
            .select(ntz("window.start").alias("window_start"), "n", "mse", "rmse", "baseline_rmse"))


def running_rmse(scored: DataFrame) -> DataFrame:
    """Cumulative RMSE over everything scored so far (sums, not a root-of-roots)."""
    se = F.pow(F.col("prediction") - F.col("rating"), 2)
    return scored.groupBy(F.lit("all").alias("scope")).agg(
        F.count("*").alias("n"), F.sum(se).alias("sse")).withColumn("rmse", F.sqrt(F.col("sse") / F.col("n")))


def sliding_count(df: DataFrame, ts: str, length: str, slide: str, watermark: str) -> DataFrame:
    s = df.withColumn("et", event_time(ts)).withWatermark("et", watermark)
    return (s.groupBy(F.window("et", length, slide)).count()
            .select(ntz("window.start").alias("window_start"), ntz("window.end").alias("window_end"), "count"))


def tumbling_count(df: DataFrame, ts: str, length: str, watermark: str) -> DataFrame:
    s = df.withColumn("et", event_time(ts)).withWatermark("et", watermark)
    return s.groupBy(F.window("et", length)).count().select(ntz("window.start").alias("window_start"), "count")
