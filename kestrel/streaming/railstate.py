"""The live rail graph kept up to date batch by batch.

Three compacted logs hold, per train, the newest schedule or deactivation and the
last deactivation, and per edge its newest version.  All are latest-wins by the
message's time and number, so messages may come late, repeated or in any order,
and the graph after a batch is that of all messages so far.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.operators import rail as RL
from kestrel.streaming.compacted import CompactedLog

_AT = "struct<msg_ts: string, seq: bigint>"
_V = "struct<live: boolean, headcode: string, toc: string, ssd: string, uid: string, train_cat: string>"
_EDGE = {"forecast_edges": "rid string, tpl string, msg_ts string, seq long, wta string, wtd string, wtp string, aat string, "
                           "aet string, dat string, det string, pat string, pet string, platform string, platsrc string, "
                           "ad int, dd int, pd int, delayed boolean",
         "schedule_edges": "rid string, tpl string, type string, pta string, ptd string, wta string, wtd string, wtp string, "
                           "act string, msg_ts string, seq long"}


def _merge_trains(rows: DataFrame) -> DataFrame:
    return rows.groupBy("rid").agg(F.max("at").alias("at"), F.max_by("v", "at").alias("v"), F.max("gone").alias("gone"))


def _merge_edges(rows: DataFrame) -> DataFrame:
    rest = [c for c in rows.columns if c != "edge_id"]
    return rows.groupBy("edge_id").agg(F.max_by(F.struct(*rest), F.struct("msg_ts", "seq")).alias("e")).select("edge_id", "e.*")


class RailGraph:
    """State tables of the graph under ``root`` in shared storage."""

    def __init__(self, spark: SparkSession, root: str, every: int = 10):
        self.trains = CompactedLog(spark, f"{root}/trains", f"rid string, at {_AT}, v {_V}, gone {_AT}", _merge_trains, every)
        self.edges = {name: CompactedLog(spark, f"{root}/{name}", f"edge_id string, {fields}", _merge_edges, every, self._after)
                      for name, fields in _EDGE.items()}

    def _after(self, edges: DataFrame) -> DataFrame:
        """Edges sent after their train's last deactivation; others can never live again."""
        gone = self.trains.read().where("gone IS NOT NULL").select("rid", "gone")
        return edges.join(gone, "rid", "left").where(
            F.col("gone").isNull() | (F.struct("msg_ts", "seq") > F.col("gone"))).drop("gone")

    def apply(self, messages: DataFrame, batch_id: int) -> None:
        """Take in a batch of XML messages (column ``value``); a replayed batch changes nothing."""
        parsed = RL.parse_messages(messages).persist()
        try:
            events = RL.vertex_events(parsed)
            self.trains.append(events.withColumn("gone", F.when(~F.col("v.live"), F.col("at"))), batch_id)
            for name, of in (("forecast_edges", RL.forecast_edges), ("schedule_edges", RL.schedule_edges)):
                self.edges[name].append(of(parsed), batch_id)
        finally:
            parsed.unpersist()

    def vertices(self) -> DataFrame:
        """Live trains."""
        return self.trains.read().where("v.live").select("rid", "v.headcode", "v.toc", "v.ssd", "v.uid", "v.train_cat")

    def live_edges(self, name: str) -> DataFrame:
        """Newest versions of the ``forecast_edges`` or ``schedule_edges`` of live trains."""
        return self._after(self.edges[name].read()).join(self.vertices().select("rid"), "rid", "left_semi").select(
            *self.edges[name].columns)


def rail_batch_fn(graph: RailGraph) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` body that keeps the graph."""
    def apply(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            graph.apply(batch, batch_id)
    return apply
