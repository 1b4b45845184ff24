"""Summaries, error metrics and splits over rating-style data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dataset_summary(ratings: DataFrame, split_col: str = "split") -> DataFrame:
    """Counts of ratings, distinct users and items, and per-split sizes — one pass."""
    return ratings.agg(
        F.count("*").alias("n_ratings"),
        F.countDistinct("user").alias("n_users"),
        F.countDistinct("item").alias("n_items"),
        F.count(F.when(F.col(split_col) == "train", 1)).alias("n_train"),
        F.count(F.when(F.col(split_col) == "validation", 1)).alias("n_validation"),
        F.count(F.when(F.col(split_col) == "test", 1)).alias("n_test"))


def numeric_stats(df: DataFrame, col: str) -> DataFrame:
    """count, mean, population stdev, max, min (``rdd.stats()``)."""
    return df.agg(F.count(col).alias("count"), F.avg(col).alias("mean"),
                  F.stddev_pop(col).alias("stdev"), F.max(col).alias("max"), F.min(col).alias("min"))


def split_by_digit(ratings: DataFrame, ts: str = "ts") -> DataFrame:
    """Deterministic 60/20/20 split on the last digit of the epoch second."""
    d = F.pmod(F.unix_timestamp(F.col(ts)), F.lit(10))
    return (ratings.withColumn("digit", d.cast("int"))
            .withColumn("split", F.when(F.col("digit") < 6, "train")
                        .when(F.col("digit") < 8, "validation").otherwise("test")))


def item_mean_predictor(train: DataFrame) -> DataFrame:
    """A deterministic stand-in model: prediction(user, item) = mean rating of the item."""
    return train.groupBy("item").agg(F.avg("rating").alias("prediction"))


def predict_pairs(model_items: DataFrame, data: DataFrame) -> DataFrame:
    """Score the distinct (user, item) pairs of ``data``; unknown items drop (cold start)."""
    pairs = data.select("user", "item").distinct()
    return pairs.join(model_items, "item")


def join_pred_actual(preds: DataFrame, data: DataFrame) -> DataFrame:
    """Predictions ⋈ actual ratings on ``(user, item)``: one row per actual rating scored."""
    return preds.join(data, ["user", "item"])


def rmse(preds: DataFrame, data: DataFrame) -> DataFrame:
    """``sqrt(sum((p - a)^2) / n)`` with ``n`` = size of the input set, as in the original job.

    One aggregate over ``data LEFT JOIN preds``: every input row counts in
    ``n_input``; only scored rows contribute squared error and ``n_joined``.
    """
    j = data.join(preds, ["user", "item"], "left")
    sq = F.pow(F.col("prediction") - F.col("rating"), 2)
    agg = j.agg(F.sum(sq).alias("sse"), F.count("prediction").alias("n_joined"),
                F.count("*").alias("n_input"))
    return agg.select(F.sqrt(F.col("sse") / F.col("n_input")).alias("rmse"), "n_joined", "n_input")


def hash_split(df: DataFrame, keys: list[str], weights: list[float], seed: int = 42, portable: bool = False) -> list[DataFrame]:
    """Deterministic split by a hash of ``keys`` (a repeatable ``randomSplit``).

    A row's part depends only on its key values, never on partitioning or
    order, so a recomputation after an executor loss yields the same rows.
    ``portable`` hashes by MD5 of ``seed:key:key...``, which other engines have too.
    """
    total = float(sum(weights))
    if portable:
        text = F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(F.col(k).cast("string"), F.lit("null")) for k in keys])
        bucket = F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / float(1 << 52)
    else:
        bucket = F.pmod(F.xxhash64(*[F.col(k) for k in keys], F.lit(seed)), F.lit(10000)) / 10000.0
    edges, acc = [], 0.0
    for w in weights:
        edges.append((acc / total, (acc + w) / total))
        acc += w
    return [df.where((bucket >= lo) & (bucket < hi)) for lo, hi in edges]
