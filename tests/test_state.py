"""Compacted logs and the rail graph kept batch by batch."""

import random

import pytest
from pyspark.sql import functions as F

from kestrel.operators import rail as RL
from kestrel.plans.state import replay_rail
from kestrel.session import scratch_path
from kestrel.streaming.compacted import CompactedLog, changelog, changelog_writer
from kestrel.streaming.railstate import RailGraph


def parts(spark, log, name):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{log.root}/{name}")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in fs.listStatus(path)) if fs.exists(path) else []


def rows(log):
    return {tuple(r) for r in log.read().select("k", "v").collect()}


def test_changelog_reads_keys_and_not_history(spark):
    log = changelog(spark, scratch_path(spark, "log"), "k string, v long", ["k"], every=2)
    write, r, want = changelog_writer(log), random.Random(1), {}
    assert rows(log) == set() and log.mark() == (-1, None)
    for b in range(7):
        new = {r.choice("abcdef"): b * 10 + i for i in range(3)}
        want |= new
        write(spark.createDataFrame(list(new.items()), "k string, v long"), b)
        assert rows(log) == set(want.items())
        assert len(parts(spark, log, "log")) <= 2 * log.every + 1       # of those, at most every + 1 are behind the snapshot
    upto, folder = log.mark()
    assert upto >= 7 - log.every - 1 and spark.read.parquet(folder).count() <= 6
    assert len(parts(spark, log, "marks")) <= 2 and len(parts(spark, log, "snapshots")) <= 2
    write(spark.createDataFrame([], "k string, v long"), 7)
    assert rows(log) == set(want.items())


def test_a_replayed_batch_replaces_itself_and_a_broken_compaction_is_invisible(spark):
    log = changelog(spark, scratch_path(spark, "log"), "k string, v long", ["k"], every=2)
    write = changelog_writer(log)

    def one(b, *pairs):
        write(spark.createDataFrame(list(pairs), "k string, v long"), b)
    one(0, ("a", 1), ("b", 1))
    one(1, ("a", 2))
    one(2, ("c", 5))                                               # makes the snapshot of batches 0 and 1
    assert log.mark()[0] == 1
    one(2, ("c", 6))                                               # the same batch again, after a failure
    assert rows(log) == {("a", 2), ("b", 1), ("c", 6)}
    spark.createDataFrame([("z", 9, 9)], log.schema).write.parquet(f"{log.root}/snapshots/000000000009-lost")
    assert rows(log) == {("a", 2), ("b", 1), ("c", 6)}             # no mark names it
    assert {tuple(r)[:2] for r in log.read(upto=1).collect()} == {("a", 2), ("b", 1)}
    with pytest.raises(ValueError):
        log.read(upto=0)
    log.compact(1)
    assert log.mark()[0] == 1


def test_merge_and_prune_are_the_callers(spark):
    def merge(df):
        return df.groupBy("k").agg(F.max("v").alias("v"))
    log = CompactedLog(spark, scratch_path(spark, "log"), "k string, v long", merge, every=1, prune=lambda d: d.where("v > 0"))
    for b, pairs in enumerate([[("a", 0), ("b", 4)], [("b", 1), ("c", 0)], [("d", 2)]]):
        log.append(spark.createDataFrame(pairs, "k string, v long"), b)
    assert rows(log) == {("b", 4), ("d", 2)}                       # a and c were pruned from the snapshot


def test_rail_graph_equals_all_messages_after_each_batch(spark, sf_dir):
    root = scratch_path(spark, "rail-graph")

    def text(df):
        return sorted(map(str, df.select(sorted(df.columns)).collect()))

    def check(i, messages):
        graph, parsed = RailGraph(spark, f"{root}/graph", 2), RL.parse_messages(messages).persist()
        assert text(graph.vertices()) == text(RL.current_vertices(parsed))
        assert text(graph.live_edges("forecast_edges")) == text(RL.current_edges(parsed))
        assert text(graph.live_edges("schedule_edges")) == text(RL.current_schedule_edges(parsed))
        if i == 2:                                                 # a batch that comes again changes nothing
            graph.apply(messages.where(F.pmod(F.xxhash64("value"), F.lit(4)) == 2), 2)
            assert text(graph.vertices()) == text(RL.current_vertices(parsed))
        parsed.unpersist()
    graph = replay_rail(spark, sf_dir, root, check)
    assert graph.trains.mark()[0] >= 1


def test_dead_edges_leave_the_snapshots(spark):
    def message(ts, body):
        return (f'<Pport ts="2024-01-01T{ts}:00.000000" seq="1"><uR>{body}</uR></Pport>',)

    def forecast(rid, tpl):
        return f'<TS rid="{rid}" uid="U" ssd="2024-01-01"><Location tpl="{tpl}" wta="10:00" wtd="10:01"/></TS>'

    def schedule(rid):
        return f'<schedule rid="{rid}" uid="U" trainId="1A01" toc="SW" ssd="2024-01-01" trainCat="OO"><OR tpl="A" wtd="09:00"/></schedule>'
    graph = RailGraph(spark, scratch_path(spark, "rail-dead"), every=1)
    batches = [[message("09:00", schedule("R1")), message("09:01", forecast("R1", "A")), message("09:01", schedule("R2"))],
               [message("11:00", '<deactivated rid="R1"/>')], [message("09:30", forecast("R1", "B")), message("09:40", forecast("R2", "C"))],
               [message("12:00", schedule("R1"))], [message("12:01", forecast("R1", "D"))]]
    for b, rows_ in enumerate(batches):
        graph.apply(spark.createDataFrame(rows_, "value string"), b)
    assert {r.rid for r in graph.vertices().collect()} == {"R1", "R2"}
    assert {r.edge_id for r in graph.live_edges("forecast_edges").collect()} == {"R2C", "R1D"}
    _, folder = graph.edges["forecast_edges"].mark()
    assert {r.edge_id for r in spark.read.parquet(folder).collect()} == {"R2C"}
