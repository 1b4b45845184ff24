"""Models refitted per micro-batch: every version's prefix and what it scored, against SQL over the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel import apps as A
from kestrel.plans.registry import query
from kestrel.session import scratch_path
from kestrel.sources import tables as TB
from kestrel.streaming import runner as RN

BATCHES = 3


def replay(spark: SparkSession, messages: DataFrame, order: str, app, root: str, batches: int = BATCHES) -> None:
    """Publish the messages in ``batches`` chunks of ``order`` and run the app once after each: a chunk is a micro-batch."""
    staged = RN.stage_files(messages, f"{root}/staged", order, batches, fmt="text", text_col="value")
    for chunk in staged.paths:
        spark.read.text(chunk).write.mode("append").text(f"{root}/feed")
        app(spark, RN.stream_source(spark, "files", path=f"{root}/feed", max_files=1_000_000), root,
            f"{root}/checkpoint").awaitTermination()


def _report(spark: SparkSession, root: str, *scored) -> DataFrame:
    """One row per batch: rows of it and of all up to it, the version that scored it and what was scored."""
    history = spark.read.parquet(f"{root}/history").groupBy("batch_id").agg(F.count("*").alias("n_batch"))
    versions = spark.read.parquet(f"{root}/model/versions").select(F.col("version").alias("batch_id"), F.col("rows").alias("n_fitted"))
    scores = spark.read.parquet(f"{root}/scores").groupBy("batch_id").agg(
        F.max("version").alias("scored_by"), F.count("*").alias("n_scored"), *scored)
    names = scores.columns[2:]
    return history.join(versions, "batch_id", "left").join(scores, "batch_id", "left").select(
        "batch_id", "n_batch", "n_fitted", "scored_by", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in names])


_CHUNK = f"CAST(least(floor(((k - lo) * {BATCHES}) / (hi - lo + 1)), {BATCHES - 1}) AS INT)"


@query("stream_als_refresh", TB.with_views(f"""
    WITH e AS (SELECT *, epoch_us(ts) AS k, min(epoch_us(ts)) OVER () AS lo, max(epoch_us(ts)) OVER () AS hi FROM ratings),
    b AS (SELECT "user", item, {_CHUNK} AS batch_id FROM e),
    u AS (SELECT "user", min(batch_id) AS seen FROM b GROUP BY ALL),
    i AS (SELECT item, min(batch_id) AS known FROM b GROUP BY ALL),
    n AS (SELECT batch_id, count(*) AS n_batch, count(*) FILTER (seen < batch_id AND known < batch_id) AS n_scored
          FROM b JOIN u USING ("user") JOIN i USING (item) GROUP BY batch_id)
    SELECT batch_id, n_batch, sum(n_batch) OVER (ORDER BY batch_id)::BIGINT AS n_fitted,
           lag(batch_id) OVER (ORDER BY batch_id) AS scored_by, n_scored FROM n""", "ratings"))
def stream_als_refresh(spark, sf_dir):
    """Ratings scored by the model of the batches before, which is refitted with every batch."""
    root = scratch_path(spark, "als-refresh")
    replay(spark, TB.rating_messages(spark, sf_dir), "ts", A.rating_refresh_app, root)
    return _report(spark, root)


def churn_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``customer, value``: churn records as JSON arrays of strings; fields that the fixture lacks are null."""
    c = TB.churn(spark, sf_dir)
    fields = [F.col(f.name).cast("string") if f.name in c.columns else F.lit(None).cast("string") for f in A.CHURN_SCHEMA.fields]
    return c.select("customer", F.to_json(F.array(*fields)).alias("value"))


@query("stream_churn_refresh", TB.with_views(f"""
    WITH e AS (SELECT customer AS k, churned, min(customer) OVER () AS lo, max(customer) OVER () AS hi FROM churn),
    n AS (SELECT {_CHUNK} AS batch_id, count(*) AS n_batch, count(*) FILTER (churned = 'True') AS p FROM e GROUP BY 1),
    r AS (SELECT *, lag(batch_id) OVER (ORDER BY batch_id) AS scored_by FROM n)
    SELECT batch_id, n_batch, sum(n_batch) OVER (ORDER BY batch_id)::BIGINT AS n_fitted, scored_by,
           CASE WHEN scored_by IS NULL THEN 0 ELSE n_batch END AS n_scored,
           CASE WHEN scored_by IS NULL THEN 0 ELSE p END AS n_churned FROM r""", "churn"))
def stream_churn_refresh(spark, sf_dir):
    """Churn records scored by the classifier of the batches before, which is refitted with every batch."""
    root = scratch_path(spark, "churn-refresh")
    replay(spark, churn_messages(spark, sf_dir), "customer", A.churn_refresh_app, root)
    return _report(spark, root, F.count_if(F.col("churned") == "True").alias("n_churned"))
