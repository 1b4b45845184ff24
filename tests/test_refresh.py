"""Models refitted per micro-batch: versions, replays, and equality with batch fits on the same prefixes."""

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.recommendation import ALSModel
from pyspark.sql import functions as F

from kestrel import apps as A
from kestrel.ml import classify as CL
from kestrel.ml import recommend as RC
from kestrel.ml.store import ModelStore
from kestrel.plans.refresh import churn_messages, replay
from kestrel.session import scratch_path
from kestrel.sources import tables as TB
from kestrel.streaming.refresh import refreshed_model


class Mean:
    """A model small enough to test the order of things: the mean of what it was fitted on."""

    def __init__(self, spark, mean):
        self.spark, self.mean = spark, mean

    def save(self, folder):
        self.spark.createDataFrame([(self.mean,)], "mean double").write.parquet(folder)


@pytest.fixture
def store(spark):
    return ModelStore(spark, scratch_path(spark, "mean-model"), lambda f: Mean(spark, spark.read.parquet(f).first()[0]))


def steps(spark, store, **more):
    root = scratch_path(spark, "mean")
    step = refreshed_model(store, f"{root}/history", lambda rows: Mean(spark, rows.agg(F.avg("x")).first()[0]),
                           lambda model, batch: batch.withColumn("error", F.col("x") - F.lit(model.mean)), f"{root}/scores", **more)
    return step, lambda: {(r.batch_id, r.version, r.x, r.error) for r in spark.read.parquet(f"{root}/scores").collect()}


def batch(spark, *values):
    return spark.createDataFrame([(float(v),) for v in values], "x double")


def test_a_batch_is_scored_by_the_version_before_it_and_replays_alike(spark, store):
    step, scores = steps(spark, store)
    data = [batch(spark, 1, 3), batch(spark, 5, 7), batch(spark, 0)]
    for i, b in enumerate(data):
        step(b, i)
    want = {(1, 0, 5.0, 3.0), (1, 0, 7.0, 5.0), (2, 1, 0.0, -4.0)}
    assert scores() == want and [store.load(v).mean for v in range(3)] == [2.0, 4.0, 3.2]
    folders = {r.version: r.folder for r in store.versions().collect()}
    step(data[1], 1)                                               # runs again although a later batch is there
    assert scores() == want and [store.load(v).mean for v in range(3)] == [2.0, 4.0, 3.2]
    now = {r.version: r.folder for r in store.versions().collect()}
    assert now[1] != folders[1] and now[0] == folders[0] and now[2] == folders[2]
    step(data[0].where("false"), 3)
    assert store.latest() == 2


def test_each_batch_alone(spark, store):
    step, scores = steps(spark, store, over="batch")
    for i, b in enumerate([batch(spark, 2), batch(spark, 4)]):
        step(b, i)
    assert store.load(1).mean == 4.0 and scores() == {(1, 0, 4.0, 2.0)}
    with pytest.raises(ValueError):
        steps(spark, store, over="week")


def test_only_committed_versions_are_seen_and_old_ones_expire(spark, store):
    assert store.latest() is None and store.versions().count() == 0
    with pytest.raises(KeyError):
        store.load(0)
    for v in range(4):
        store.save(Mean(spark, float(v)), v, 1)
    Mean(spark, 9.0).save(f"{store.root}/models/000000009-lost")   # saved, but its batch never came to the record
    assert store.latest() == 3 and store.latest(before=3) == 2 and store.latest(before=0) is None
    assert store.expire(2) == [0, 1]
    assert sorted(r.version for r in store.versions().collect()) == [2, 3] and store.load(2).mean == 2.0
    with pytest.raises(Exception, match="(?i)path|exist"):
        spark.read.parquet(f"{store.root}/models/000000009-lost")


def test_rating_stream_equals_fits_on_the_same_prefixes(spark, sf_dir):
    root = scratch_path(spark, "als-prefix")
    replay(spark, TB.rating_messages(spark, sf_dir), "ts", A.rating_refresh_app, root, 2)
    store = ModelStore(spark, f"{root}/model", ALSModel.load)
    history = spark.read.parquet(f"{root}/history")
    for v in range(2):
        rows = history.where(F.col("batch_id") <= v)
        want = RC.als().fit(rows).transform(rows).select("user", "item", F.col("prediction").alias("w")).distinct()
        both = store.load(v).transform(rows).join(want, ["user", "item"])
        assert both.count() == rows.count() and both.agg(F.max(F.abs(F.col("prediction") - F.col("w")))).first()[0] < 1e-3
    scored = spark.read.parquet(f"{root}/scores")
    again = store.load(0).transform(history.where("batch_id = 1")).agg(F.count("*"), F.sum(F.round("prediction", 1))).first()
    assert tuple(scored.agg(F.count("*"), F.sum("prediction")).first()) == pytest.approx(tuple(again))


def test_churn_stream_equals_fits_on_the_same_prefixes(spark, sf_dir):
    big = sf_dir.replace("sf0.001", "sf0.01")
    root = scratch_path(spark, "churn-prefix")
    replay(spark, churn_messages(spark, big), "customer", A.churn_refresh_app, root, 2)
    store = ModelStore(spark, f"{root}/model", PipelineModel.load)
    history = spark.read.parquet(f"{root}/history")
    first, second = (history.where(F.col("batch_id") == v) for v in range(2))
    want = CL.churn_scores(CL.fit_classifier(first, CL.decision_tree()), second)
    got = spark.read.parquet(f"{root}/scores")
    key = ["state", "account_length", "total_day_charge"]
    both = got.join(want.select(*key, F.col("score").alias("w"), F.col("predicted").alias("p")), key)
    assert both.count() == second.count()
    assert both.where("abs(score - w) > 1e-9 OR predicted != p").count() == 0
    assert store.versions().agg(F.sum("rows")).first()[0] == first.count() + history.count()
    auc = CL.auc_by(got, "batch_id", F.col("churned") == "True").first().auc
    assert 0.5 < auc <= 1


def test_auc_counts_ties_half(spark):
    df = spark.createDataFrame([(1, 0.1, "f"), (1, 0.4, "t"), (1, 0.4, "f"), (1, 0.9, "t"), (2, 0.5, "t")], "g int, score double, y string")
    got = {r.g: r.auc for r in CL.auc_by(df, "g", F.col("y") == "t").collect()}
    assert got == {1: (1.5 + 2) / 4, 2: None}


def test_timed_micro_batches_process_what_arrives(spark):
    """A stream on a processing-time trigger picks up files until it is stopped."""
    import time

    from kestrel.streaming import runner as RN
    src, out = scratch_path(spark, "timed-src"), scratch_path(spark, "timed-out")
    batch(spark, 1).selectExpr("'first' AS value").write.mode("append").text(src)
    q = RN.start(RN.stream_source(spark, "files", path=src, max_files=100), RN.batch_partition_writer(out),
                 scratch_path(spark, "timed-ck"), processing_time="1 second")

    def seen():
        try:
            return {r.value for r in spark.read.parquet(out).collect()}
        except Exception:
            return set()

    def wait_for(want):
        end = time.time() + 60
        while seen() != want and time.time() < end:
            time.sleep(0.5)
        assert seen() == want
    try:
        wait_for({"first"})
        batch(spark, 1).selectExpr("'second' AS value").write.mode("append").text(src)
        wait_for({"first", "second"})
        assert q.isActive and len({p["batchId"] for p in q.recentProgress if p["numInputRows"]}) == 2
    finally:
        q.stop()
