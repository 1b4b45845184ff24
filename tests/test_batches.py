"""Staged replays: the micro-batches follow from the chunks, not from how many tasks wrote them."""

import glob

import pytest
from pyspark.sql import functions as F

from kestrel.plans.registry import QUERIES, load_all
from kestrel.session import shared_dir
from kestrel.streaming import jobs as J
from kestrel.streaming import runner as RN
from kestrel.streaming.lateness import LateRowsError

PARTS = 6                        # files per table, so that a chunk has several


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """A folder of driver tables, each in several files."""
    root = str(tmp_path_factory.mktemp("tables"))
    made = {
        "events": spark.range(240).select(
            F.col("id").alias("event_id"), F.expr("TIMESTAMP_NTZ'2024-01-01' + make_dt_interval(0, 0, id * 97)").alias("ts"),
            (F.col("id") % 7).alias("user_id"), F.lit("view").alias("event_type"), (F.col("id") * 1.5).alias("value"),
            F.lit('{"k": 1}').alias("props")),
        "customer": spark.range(7).select(
            F.col("id").alias("c_custkey"), F.format_string("C%d", "id").alias("c_name"), F.col("id").cast("int").alias("c_nationkey"),
            (F.col("id") * 1.0).alias("c_acctbal"), F.lit("BUILDING").alias("c_mktsegment")),
        "part": spark.range(300).select(F.col("id").alias("p_partkey"), F.format_string("part %d", "id").alias("p_name")),
        "documents": spark.range(120).select(
            F.col("id").alias("doc_id"), F.concat(F.lit("one,two three,"), F.col("id").cast("string")).alias("text")),
        "conversations": spark.range(60).select(
            F.col("id").alias("conv_id"), F.lit(1).cast("long").alias("turn"), F.lit("four,one five").alias("text")),
    }
    for name, df in made.items():
        df.repartition(PARTS).write.parquet(f"{root}/{name}.parquet")
    return root


def _batches(monkeypatch, spark, tables, name):
    """(result rows of a query, how many micro-batches each of its runs took)."""
    load_all()
    runs, run = [], RN.run_available_now

    def counted(stream, fn, *args, **kwargs):
        seen = set()

        def body(batch, batch_id):
            seen.add(batch_id)
            fn(batch, batch_id)
        run(stream, body, *args, **kwargs)
        runs.append(len(seen))
    monkeypatch.setattr(RN, "run_available_now", counted)
    return QUERIES[name](spark, tables).collect(), runs


def _words(spark, tables, sep):
    text = [r.text for t in ("documents", "conversations") for r in spark.read.parquet(f"{tables}/{t}.parquet").collect()]
    return sorted(w for x in text for w in x.split(sep))


@pytest.mark.parametrize("name, sep", [("stream_window_wordcount", " "), ("stream_running_wordcount", ","),
                                       ("stream_compacted_wordcount", ",")])
def test_a_word_count_takes_a_batch_per_chunk(spark, tables, monkeypatch, name, sep):
    rows, runs = _batches(monkeypatch, spark, tables, name)
    assert len(runs) == 1 and runs[0] <= 5 + 1      # and one in which the watermark closes the last windows
    assert sorted(w for r in rows for w in [r.word] * r["count"]) == _words(spark, tables, sep)


def test_a_stateful_batch_is_computed_once(spark, tmp_path):
    ran = spark.sparkContext.accumulator(0)

    def note(rows):
        for r in rows:
            ran.add(1)
            yield r
    spark.range(20).selectExpr("CAST(id % 4 AS STRING) AS text").coalesce(1).write.parquet(f"{tmp_path}/in")
    counts = RN.file_stream(spark, f"{tmp_path}/in", "text string").groupBy("text").count().mapInPandas(note, "text string, count long")
    RN.run_available_now(counts, RN.batch_partition_writer(f"{tmp_path}/out"), f"{tmp_path}/ckpt", mode="update")
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert 0 < ran.value <= partitions              # a block of rows per partition with rows, each seen once
    assert {(r.text, r["count"]) for r in RN.read_changelog(spark, f"{tmp_path}/out", ["text"]).collect()} == {
        (str(i), 5) for i in range(4)}


def test_the_customer_index_takes_a_batch_per_chunk(spark, tables, monkeypatch):
    rows, runs = _batches(monkeypatch, spark, tables, "stream_foreach_batch")
    assert len(runs) == 1 and runs[0] <= 5
    assert len(rows) == 240 and len({r.tstamp for r in rows}) == 240


def test_a_restarted_count_takes_a_batch_per_chunk(spark, tables, monkeypatch):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")       # the copies of a chunk have several files too
    try:
        rows, runs = _batches(monkeypatch, spark, tables, "stream_restart_wordcount")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(runs) == 2 and runs[0] <= 3 and runs[1] <= 2
    assert sorted(w for r in rows for w in [r.word] * r["count"]) == _words(spark, tables, ",")


@pytest.mark.parametrize("name", ["stream_static_join", "rating_error_docs", "batch_rmse_baseline", "recommendation_docs"])
def test_a_rating_stream_takes_a_batch_per_chunk(spark, tables, monkeypatch, name):
    rows, runs = _batches(monkeypatch, spark, tables, name)
    assert len(runs) == 1 and runs[0] <= 5 + 1
    if name == "batch_rmse_baseline":
        assert 0 < sum(r.n for r in rows) <= 240
    elif name != "recommendation_docs":
        assert 0 < len(rows) <= 240


def _counting(spark, df):
    """(``df`` in one partition, a count of how often it was computed)."""
    ran = spark.sparkContext.accumulator(0)

    def note(blocks):
        ran.add(1)
        yield from blocks
    return df.coalesce(1).mapInPandas(note, df.schema), ran


def test_churn_features_are_computed_once(spark, monkeypatch):
    from kestrel.sources import tables as TB
    load_all()
    number = [((F.col("id") * (i + 3)) % 17).cast("double").alias(c) for i, c in enumerate(TB.CHURN_NUMERIC)]
    rows, ran = _counting(spark, spark.range(300).select(
        F.col("id").alias("customer"), F.lit("s").alias("state"), *number, F.lit(1.0).alias("number_customer_service_calls"),
        F.expr("IF(id % 3 = 0, 'yes', 'no')").alias("intl_plan"), F.expr("IF(id * 3 % 17 < 6, 'True', 'False')").alias("churned")))
    monkeypatch.setattr(TB, "churn", lambda spark, sf_dir: rows)
    out = QUERIES["churn_checks"](spark, "").collect()
    assert ran.value == 1
    assert len(out) == 2 and all(r.n_train + r.n_test == 300 for r in out)


def test_rail_messages_are_written_from_one_computation(spark, tables, monkeypatch):
    from kestrel.plans import state
    messages, ran = _counting(spark, state.rail_xml(spark, tables))
    monkeypatch.setattr(state, "rail_xml", lambda spark, sf_dir: messages)
    seen = []
    state.replay_rail(spark, tables, state.scratch_path(spark, "rail-once"), lambda i, feed: seen.append(feed.count()))
    assert ran.value == 1 and seen[-1] == 240


def test_the_windows_words_are_kept_on_disk(spark, tables, monkeypatch):
    """The keys grow with the input: RocksDB commits its changes as .changelog files, the store in the heap as .delta."""
    runs = f"{shared_dir(spark).removeprefix('file:')}/kestrel/window-wc-ckpt-*"
    earlier = set(glob.glob(runs))
    rows, _ = _batches(monkeypatch, spark, tables, "stream_window_wordcount")
    assert sorted(w for r in rows for w in [r.word] * r["count"]) == _words(spark, tables, " ")
    assert len({(r.window_start, r.word) for r in rows}) == len(rows)
    run, = set(glob.glob(runs)) - earlier
    assert glob.glob(f"{run}/state/0/*/*.changelog") and not glob.glob(f"{run}/state/**/*.delta", recursive=True)


def _settings(spark):
    return {k: spark.conf.get(k, None) for k in RN.DISK_STATE}


def test_a_run_leaves_the_sessions_store(spark):
    before = _settings(spark)
    with RN.state_on_disk(spark):
        assert _settings(spark) == RN.DISK_STATE
    assert _settings(spark) == before
    with pytest.raises(ZeroDivisionError), RN.state_on_disk(spark):
        assert _settings(spark) == RN.DISK_STATE
        raise ZeroDivisionError
    assert _settings(spark) == before


def test_late_rows_fail_a_run_with_its_state_on_disk(spark, tmp_path):
    """A row behind the watermark is an error with either store; nothing is dropped unseen."""
    for i, at in enumerate(("2024-01-01", "2024-01-08", "2024-01-09", "2024-01-02")):
        spark.sql(f"SELECT TIMESTAMP_NTZ'{at}' AS ts, 'a b' AS text").coalesce(1).write.parquet(f"{tmp_path}/in/{i}")
    lines = RN.file_stream(spark, f"{tmp_path}/in", "ts timestamp_ntz, text string")
    with pytest.raises(LateRowsError):
        RN.run_update_aggregate(spark, J.tumbling_word_count(lines, "1 day", "1 hour"), ["window_start", "word"], "late-wc",
                                disk_state=True)
    counts = RN.run_update_aggregate(spark, J.tumbling_word_count(lines, "1 day", "20 days"), ["window_start", "word"],
                                     "all-wc", disk_state=True)
    assert {(str(r.window_start)[:10], r.word, r["count"]) for r in counts.collect()} == {
        (f"2024-01-0{d}", w, 1) for d in (1, 2, 8, 9) for w in "ab"}
