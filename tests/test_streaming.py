"""Streaming semantics: watermark drops late rows; replayed batches are idempotent."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from kestrel.session import scratch_path
from kestrel.streaming import jobs as J
from kestrel.streaming import runner as RN

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "tstamp timestamp_ntz, nino string"


def test_rows_behind_the_watermark_fail_the_run(spark):
    src = scratch_path(spark, "late-src")
    on_time = [(T0 + dt.timedelta(hours=10, minutes=m), "a") for m in range(3)]
    late = [(T0 + dt.timedelta(hours=1), "late")]          # 9 h behind, watermark 1 h
    fresh = [(T0 + dt.timedelta(hours=10, minutes=30), "b")]
    for i, rows in enumerate([on_time, late + fresh]):
        spark.createDataFrame(rows, SCHEMA).write.parquet(f"{src}/chunk={i:05d}")
    stream = RN.file_stream(spark, src, spark.createDataFrame([], SCHEMA).schema)
    with pytest.raises(RuntimeError, match="1 rows"):
        RN.run_update_aggregate(spark, J.tumbling_count(stream, "tstamp", "1 hour", "1 hour"), ["window_start"], "late")
    out = RN.run_update_aggregate(spark, J.tumbling_count(stream, "tstamp", "1 hour", "10 hours"), ["window_start"], "all")
    assert sum(r["count"] for r in out.collect()) == 5


@pytest.mark.parametrize("parts", [4, 16])
def test_chunks_of_many_files_in_any_order_lose_no_row(spark, sf_dir, parts):
    from kestrel.operators.risk import risk_flags
    from kestrel.sources import tables as TB
    from kestrel.streaming.risk import run_risk_flags
    cust = TB.customers(spark, sf_dir).select("tstamp", "nino", "housing", "childcare").repartition(parts)
    src = scratch_path(spark, "many-files")
    staged = RN.stage_files(cust, src, "tstamp", 2)
    agg = J.tumbling_count(RN.file_stream(spark, src, cust.schema, max_files=parts // 2), "tstamp", "1 hour", staged.lateness())
    out = RN.run_update_aggregate(spark, agg, ["window_start"], "many")
    assert out.agg(F.sum("count")).first()[0] == cust.count()
    slide, w = 6 * 3600, 10
    root = scratch_path(spark, "risk-shuffled")
    stream = RN.file_stream(spark, src, cust.schema, max_files=parts // 2)
    run_risk_flags(spark, stream, root, scratch_path(spark, "risk-ck"), slide, w, lateness_slots=staged.span // slide + 1)
    assert spark.read.parquet(f"{root}/meta").agg(F.sum("late_rows")).first()[0] == 0
    kept = spark.read.option("basePath", f"{root}/values").parquet(f"{root}/values")
    assert kept.count() == 2 * cust.count()
    # the newest thresholds of every window are those of the batch form
    from kestrel.operators.risk import long_costs, window_thresholds
    want = {(r.risk_category, r.end_slot): r.kth for r in window_thresholds(long_costs(cust), slide, w).collect()}
    got = {(r.risk_category, r.end_slot): r.kth for r in spark.read.parquet(f"{root}/thresholds").orderBy("batch_id").collect()}
    assert all(got[x] == want[x] for x in want)
    assert risk_flags(cust, slide, w).count() > 0


def test_late_risk_rows_are_kept_and_counted(spark):
    from kestrel.streaming.risk import risk_flag_batch_fn, run_risk_flags
    schema = "tstamp timestamp_ntz, nino string, housing double, childcare double"
    rows = [[(T0 + dt.timedelta(hours=h), f"n{h}", float(h), 1.0) for h in (9, 10)], [(T0, "late", 5.0, 1.0)]]
    src, root = scratch_path(spark, "late-risk"), scratch_path(spark, "late-risk-state")
    for i, r in enumerate(rows):
        spark.createDataFrame(r, schema).write.parquet(f"{src}/chunk={i:05d}")
    stream = RN.file_stream(spark, src, spark.createDataFrame([], schema).schema, max_files=10)
    run_risk_flags(spark, RN.file_stream(spark, f"{src}/chunk=00000", stream.schema, max_files=10), root,
                   scratch_path(spark, "ck"), 3600, 3)
    fn = risk_flag_batch_fn(spark, root, 3600, 3)
    last = max(r.batch_id for r in spark.read.parquet(f"{root}/meta").collect())
    fn(spark.read.parquet(f"{src}/chunk=00001"), last + 1)
    assert spark.read.parquet(f"{root}/late").where("batch_id = %d" % (last + 1)).count() == 2
    assert spark.read.parquet(f"{root}/meta/batch_id={last + 1}").first()["late_rows"] == 2


def test_replayed_batch_overwrites_its_partition(spark):
    out = scratch_path(spark, "replay")
    w = RN.batch_partition_writer(out)
    df = spark.range(5).withColumn("x", F.col("id") * 2)
    w(df, 0)
    w(df, 1)
    w(df, 1)   # the same batch again after a failure
    assert spark.read.parquet(out).count() == 10


def test_streaming_risk_flags_equal_batch_with_many_batches_and_gaps(spark, sf_dir):
    from kestrel.operators.risk import risk_flags
    from kestrel.sources import tables as TB
    from kestrel.streaming.risk import run_risk_flags
    cust = TB.customers(spark, sf_dir).select("tstamp", "nino", "housing", "childcare")
    src = scratch_path(spark, "risk-many")
    RN.stage_files(cust, src, "tstamp", 8)
    key = ["tstamp", "nino", "risk_category", "cost"]
    for slide, w in [(3600, 3), (6 * 3600, 10), (1800, 24)]:
        stream = RN.file_stream(spark, src, cust.schema)
        got = run_risk_flags(spark, stream, scratch_path(spark, "risk-state"), scratch_path(spark, "risk-ck"), slide, w)
        want = risk_flags(cust, slide, w)
        assert sorted(map(tuple, got.select(key).collect())) == sorted(map(tuple, want.select(key).collect()))


def test_rows_dropped_before_the_last_progress_reports_fail_the_run(spark, tmp_path):
    for i, day in enumerate(["10", "11", "12", "01", "13", "14", "15", "16"]):   # the fourth file comes behind the watermark
        (spark.sql(f"SELECT TIMESTAMP'2020-01-{day} 00:00:00' AS ts").coalesce(1).write.parquet(f"{tmp_path}/in/chunk={i}"))
    kept = "spark.sql.streaming.numRecentProgressUpdates"
    before = spark.conf.get(kept)
    spark.conf.set(kept, "2")
    try:
        counts = (RN.file_stream(spark, f"{tmp_path}/in", "ts timestamp").withWatermark("ts", "1 hour")
                  .groupBy(F.window("ts", "1 hour")).count())
        with pytest.raises(RuntimeError, match="behind the watermark"):
            RN.run_available_now(counts, lambda batch, i: batch.count(), f"{tmp_path}/ckpt", mode="update")
        assert spark.conf.get(kept) == "2"
    finally:
        spark.conf.set(kept, before)


def test_a_long_running_query_fails_once_rows_were_dropped(spark, tmp_path):
    import time

    from pyspark.errors import StreamingQueryException

    def publish(i, day):
        spark.sql(f"SELECT TIMESTAMP'2020-01-{day} 00:00:00' AS ts").coalesce(1).write.parquet(f"{tmp_path}/in/chunk={i}")
    publish(0, "10")
    counts = (RN.file_stream(spark, f"{tmp_path}/in", "ts timestamp").withWatermark("ts", "1 hour")
              .groupBy(F.window("ts", "1 hour")).count())
    q = RN.start(counts, lambda batch, i: batch.count(), f"{tmp_path}/ckpt", mode="update", processing_time="200 milliseconds")
    try:
        for i, day in enumerate(["11", "12", "01", "13", "14", "15", "16", "17"], 1):
            publish(i, day)
            if not q.isActive:
                break
            time.sleep(1)
        with pytest.raises(StreamingQueryException, match="behind the watermark"):
            q.awaitTermination(60)
            raise AssertionError("the query goes on")
    finally:
        q.stop()
