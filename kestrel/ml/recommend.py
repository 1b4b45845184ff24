"""ALS recommender jobs: train, tune on a fixed split, evaluate, recommend, persist."""

from __future__ import annotations

import itertools
from dataclasses import dataclass

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel.operators import stats as S

SEED = 42
# Tuning grid of the original job (fixed values).
GRID_RANKS = [8, 12]
GRID_LAMBDAS = [0.1, 10.0]
GRID_ITERS = [10, 20]


def als(rank: int = 8, max_iter: int = 10, reg: float = 0.1, implicit: bool = False, alpha: float = 1.0) -> ALS:
    return ALS(rank=rank, maxIter=max_iter, regParam=reg, implicitPrefs=implicit, alpha=alpha,
               userCol="user", itemCol="item", ratingCol="rating", coldStartStrategy="drop",
               seed=SEED, checkpointInterval=5)


def evaluate_rmse(model: ALSModel, data: DataFrame) -> float:
    """RMSE of ``model`` on ``data``, divided by the size of ``data`` (cold-start rows count)."""
    preds = model.transform(data.select("user", "item").distinct()).select("user", "item", "prediction")
    return S.rmse(preds, data).first()["rmse"]


@dataclass
class GridResult:
    table: DataFrame
    best: ALSModel


def grid_search(spark: SparkSession, train: DataFrame, validation: DataFrame, test: DataFrame,
                ranks=GRID_RANKS, lambdas=GRID_LAMBDAS, iters=GRID_ITERS) -> GridResult:
    """Fit every configuration on ``train``, keep the lowest validation RMSE, report its test RMSE.

    The split is fixed (not re-drawn per fit), as in the original job.  Each
    fit is a distributed ALS; the loop only walks the 8 configurations.
    """
    train = train.persist()
    rows, best, best_rmse = [], None, float("inf")
    for rank, reg, n_iter in itertools.product(ranks, lambdas, iters):
        model = als(rank, n_iter, reg).fit(train)
        v = evaluate_rmse(model, validation)
        rows.append((rank, float(reg), n_iter, float(v)))
        if v < best_rmse:
            best, best_rmse, best_cfg = model, v, (rank, reg, n_iter)
    test_rmse = evaluate_rmse(best, test)
    schema = T.StructType([T.StructField("rank", T.IntegerType()), T.StructField("reg", T.DoubleType()),
                           T.StructField("iters", T.IntegerType()), T.StructField("validation_rmse", T.DoubleType())])
    table = spark.createDataFrame(rows, schema).withColumn(
        "is_best", (F.col("rank") == best_cfg[0]) & (F.col("reg") == float(best_cfg[1])) & (F.col("iters") == best_cfg[2])
    ).withColumn("test_rmse", F.when(F.col("is_best"), F.lit(test_rmse)))
    train.unpersist()
    return GridResult(table, best)


def top_n_for_user(model: ALSModel, user: int, candidates: DataFrame, n: int, catalog: DataFrame) -> DataFrame:
    """Score one user's candidate items, keep the best ``n`` with rank and ASCII title."""
    pairs = candidates.select(F.lit(user).cast("int").alias("user"), "item")
    scored = model.transform(pairs).where(F.col("prediction").isNotNull())
    top = scored.orderBy(F.desc("prediction"), "item").limit(n)
    w = Window.orderBy(F.desc("prediction"), "item")        # n rows
    return (top.join(catalog, "item").select(
        F.row_number().over(w).alias("rank"), "item",
        F.regexp_replace("title", r"[^\x00-\x7F]", "").alias("title"), "prediction"))


def recommend_for(model: ALSModel, users: DataFrame, k: int, catalog: DataFrame) -> DataFrame:
    """Top-``k`` items for every user in ``users`` (blocked on the factor tables, no pair explosion)."""
    recs = model.recommendForUserSubset(users.select("user").distinct(), k)
    ex = recs.select("user", F.posexplode("recommendations").alias("pos", "rec"))
    return ex.select("user", (F.col("pos") + 1).alias("rank"), F.col("rec.item").alias("item"),
                     F.col("rec.rating").alias("rating")).join(catalog, "item", "left")


def recommendation_docs(recs: DataFrame) -> DataFrame:
    """One document per user: the top items as an ordered ``array<struct<rank,item,title,rating>>``."""
    return recs.groupBy("user").agg(
        F.sort_array(F.collect_list(F.struct("rank", "item", "title", "rating"))).alias("top5recommendations"))
