"""Keyed stream state over compacted logs: the rail graph and running word counts, against the batch meaning in SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from kestrel import apps as A
from kestrel.plans.registry import ORACLES, query
from kestrel.plans import documents, streams  # noqa: F401  (the batch meaning is their SQL)
from kestrel.session import scratch_path
from kestrel.sources import tables as TB
from kestrel.sources.railfeed import rail_xml
from kestrel.streaming import jobs as J
from kestrel.streaming import runner as RN
from kestrel.streaming.compacted import changelog, changelog_writer
from kestrel.streaming.railstate import RailGraph

BATCHES = 4
EVERY = 2                        # batches between snapshots


def replay_rail(spark, sf_dir: str, root: str, after_batch=None) -> RailGraph:
    """Publish the rail messages in ``BATCHES`` parts, in no order of time, and run the app once after each."""
    feed = f"{root}/feed"
    with RN.computed_once(rail_xml(spark, sf_dir)) as messages:
        for i in range(BATCHES):
            messages.where(F.pmod(F.xxhash64("value"), F.lit(BATCHES)) == i).write.mode("append").text(feed)
            A.rail_graph_app(spark, RN.stream_source(spark, "files", path=feed, max_files=1_000_000), f"{root}/graph",
                             f"{root}/checkpoint", every=EVERY).awaitTermination()
            if after_batch is not None:
                after_batch(i, spark.read.text(feed))
    return RailGraph(spark, f"{root}/graph", EVERY)


@query("stream_rail_state", ORACLES["rail_current_state"])
def stream_rail_state(spark, sf_dir):
    """Live trains, kept batch by batch."""
    return replay_rail(spark, sf_dir, scratch_path(spark, "rail-state")).vertices()


@query("stream_rail_edges", ORACLES["rail_current_edges"])
def stream_rail_edges(spark, sf_dir):
    """Live forecast edges, kept batch by batch."""
    return replay_rail(spark, sf_dir, scratch_path(spark, "rail-edges")).live_edges("forecast_edges")


@query("stream_compacted_wordcount", ORACLES["stream_running_wordcount"])
def stream_compacted_wordcount(spark, sf_dir):
    """Running word counts whose changelog is compacted into snapshots on the way."""
    root = scratch_path(spark, "compacted-wc")
    lines = TB.timed_lines(spark, sf_dir)
    staged = RN.stage_files(lines, f"{root}/feed", "ts", BATCHES + 1)
    log = changelog(spark, f"{root}/counts", "word string, count long", ["word"], EVERY)
    stream = RN.file_stream(spark, f"{root}/feed", lines.schema, max_files=staged.files)
    counts = J.running_word_count(stream, ",")
    RN.run_available_now(counts, changelog_writer(log), f"{root}/checkpoint", mode="update")
    return log.read().select("word", "count")
