"""Rail push-feed messages → train-status edges, schedule vertices/edges, current graph state.

Messages are XML documents (``Pport`` root).  ``from_xml`` with an explicit
schema parses them; namespace prefixes are ignored, attributes arrive as
``_name`` and element text as ``_VALUE``; a single repeated element parses into
a one-element array, so no scalar-or-list normalisation is needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel.functions.timecols import hhmm_minutes_between

S = T.StringType()


def _attrs(*names: str) -> list[T.StructField]:
    return [T.StructField(f"_{n}", S) for n in names]


_TIMES = _attrs("at", "et", "wet", "delayed", "src", "srcInst")
LOCATION = T.StructType(_attrs("tpl", "pta", "ptd", "wta", "wtd", "wtp") + [
    T.StructField("arr", T.StructType(_TIMES)),
    T.StructField("dep", T.StructType(_TIMES)),
    T.StructField("pass", T.StructType(_attrs("at", "et", "delayed"))),
    T.StructField("plat", T.StructType([T.StructField("_VALUE", S)] +
                                        _attrs("platsup", "cisPlatsup", "platsrc", "conf"))),
])
POINT = T.StructType(_attrs("tpl", "act", "pta", "ptd", "wta", "wtd", "wtp"))
# Point types of a schedule, in calling order (fixed by the feed format).
POINT_TYPES = ["OR", "PP", "IP", "OPIP", "DT"]

PPORT = T.StructType(_attrs("ts", "seq") + [T.StructField("uR", T.StructType(
    _attrs("requestSource", "updateOrigin") + [
        T.StructField("TS", T.StructType(_attrs("rid", "uid", "ssd") + [
            T.StructField("Location", T.ArrayType(LOCATION))])),
        T.StructField("schedule", T.StructType(
            _attrs("rid", "uid", "trainId", "toc", "ssd", "trainCat")
            + [T.StructField(t, T.ArrayType(POINT)) for t in POINT_TYPES])),
        T.StructField("deactivated", T.StructType(_attrs("rid"))),
    ]))])


def parse_messages(raw: DataFrame, value: str = "value") -> DataFrame:
    """XML text → one nested ``msg`` struct per message (malformed → NULL fields).

    The parse is wrapped in a one-element ``inline``: the optimizer neither
    pushes predicates below a generator nor collapses projections through it,
    so every message is parsed exactly once however many fields are read.
    """
    parsed = F.from_xml(F.col(value), PPORT, {"ignoreNamespace": "true", "mode": "PERMISSIVE"})
    return raw.select(F.inline(F.array(F.struct(parsed.alias("msg")))))


def message_header(parsed: DataFrame, extra: list | None = None) -> DataFrame:
    """Envelope fields of every message: time, sequence, kind, train id, origin."""
    m = F.col("msg")
    return parsed.select(*(extra or []),
        m["_ts"].alias("msg_ts"), m["_seq"].cast("long").alias("seq"),
        F.when(m["uR"]["TS"].isNotNull(), "TS").when(m["uR"]["schedule"].isNotNull(), "schedule")
        .when(m["uR"]["deactivated"].isNotNull(), "deactivated").alias("kind"),
        F.coalesce(m["uR"]["TS"]["_rid"], m["uR"]["schedule"]["_rid"], m["uR"]["deactivated"]["_rid"]).alias("rid"),
        m["uR"]["_requestSource"].alias("request_source"), m["uR"]["_updateOrigin"].alias("update_origin"))


def _late(sched, actual, estimated, wet=None) -> F.Column:
    """Minutes late against the working time: actual, else (wet, else) estimate; 0 if none."""
    seen = F.coalesce(actual, wet, estimated) if wet is not None else F.coalesce(actual, estimated)
    return F.coalesce(hhmm_minutes_between(sched, seen), F.lit(0))


def forecast_edges(parsed: DataFrame) -> DataFrame:
    """One edge per calling/passing point of every train-status message.

    Edge id = ``rid + tpl``; ``ad``/``dd``/``pd`` = minutes late on arrival,
    departure, pass; ``delayed`` when any of them exceeds one minute.
    """
    ts = parsed.where(F.col("msg.uR.TS").isNotNull()).select(
        F.col("msg._ts").alias("msg_ts"), F.col("msg._seq").cast("long").alias("seq"),
        F.col("msg.uR.TS._rid").alias("rid"), F.col("msg.uR.TS._uid").alias("uid"),
        F.col("msg.uR.TS._ssd").alias("ssd"), F.explode("msg.uR.TS.Location").alias("loc"))
    l = F.col("loc")
    e = ts.select(
        F.concat("rid", l["_tpl"]).alias("edge_id"), "rid", l["_tpl"].alias("tpl"), "msg_ts", "seq",
        l["_wta"].alias("wta"), l["_wtd"].alias("wtd"), l["_wtp"].alias("wtp"),
        l["arr"]["_at"].alias("aat"), F.coalesce(l["arr"]["_wet"], l["arr"]["_et"]).alias("aet"),
        l["dep"]["_at"].alias("dat"), F.coalesce(l["dep"]["_wet"], l["dep"]["_et"]).alias("det"),
        l["pass"]["_at"].alias("pat"), l["pass"]["_et"].alias("pet"),
        l["plat"]["_VALUE"].alias("platform"), l["plat"]["_platsrc"].alias("platsrc"),
        _late(l["_wta"], l["arr"]["_at"], l["arr"]["_et"], l["arr"]["_wet"]).alias("ad"),
        _late(l["_wtd"], l["dep"]["_at"], l["dep"]["_et"], l["dep"]["_wet"]).alias("dd"),
        _late(l["_wtp"], l["pass"]["_at"], l["pass"]["_et"]).alias("pd"))
    return e.withColumn("delayed", (F.col("ad") > 1) | (F.col("dd") > 1) | (F.col("pd") > 1))


def schedule_vertices(parsed: DataFrame) -> DataFrame:
    s = F.col("msg.uR.schedule")
    return parsed.where(s.isNotNull()).select(
        s["_rid"].alias("rid"), s["_trainId"].alias("headcode"), s["_toc"].alias("toc"), s["_ssd"].alias("ssd"),
        s["_uid"].alias("uid"), s["_trainCat"].alias("train_cat"),
        F.col("msg._ts").alias("msg_ts"), F.col("msg._seq").cast("long").alias("seq"))


def schedule_edges(parsed: DataFrame) -> DataFrame:
    """One edge ``rid → tpl`` per schedule point, tagged with its point type."""
    s = F.col("msg.uR.schedule")
    def tag(t):
        return lambda p: F.struct(F.lit(t).alias("type"), p.alias("p"))
    tagged = F.concat(*[F.transform(F.coalesce(s[t], F.array().cast(T.ArrayType(POINT))), tag(t))
                        for t in POINT_TYPES])
    x = parsed.where(s.isNotNull()).select(
        s["_rid"].alias("rid"), F.col("msg._ts").alias("msg_ts"), F.col("msg._seq").cast("long").alias("seq"),
        F.explode(tagged).alias("pt"))
    p = F.col("pt.p")
    return x.select(F.concat(p["_tpl"], F.col("rid")).alias("edge_id"), "rid", p["_tpl"].alias("tpl"),
                    F.col("pt.type").alias("type"), p["_pta"].alias("pta"), p["_ptd"].alias("ptd"),
                    p["_wta"].alias("wta"), p["_wtd"].alias("wtd"), p["_wtp"].alias("wtp"),
                    p["_act"].alias("act"), "msg_ts", "seq")


def vertex_events(parsed: DataFrame) -> DataFrame:
    """Schedule upserts and deactivation tombstones as ``(rid, at, v)`` records
    (a tombstone has ``v.live = false``)."""
    s = F.col("msg")["uR"]["schedule"]
    d = F.col("msg")["uR"]["deactivated"]
    return parsed.where(s.isNotNull() | d.isNotNull()).select(
        F.coalesce(s["_rid"], d["_rid"]).alias("rid"),
        F.struct(F.col("msg")["_ts"].alias("msg_ts"), F.col("msg")["_seq"].cast("long").alias("seq")).alias("at"),
        F.struct(s.isNotNull().alias("live"), s["_trainId"].alias("headcode"), s["_toc"].alias("toc"),
                 s["_ssd"].alias("ssd"), s["_uid"].alias("uid"), s["_trainCat"].alias("train_cat")).alias("v"))


def latest_vertices(events: DataFrame) -> DataFrame:
    """Latest-wins per ``rid``; ``max_by`` aggregates partially before the
    shuffle, so a busy train id costs no single task.  Tombstoned trains drop."""
    latest = events.groupBy("rid").agg(F.max_by("v", "at").alias("v"))
    return latest.where(F.col("v.live")).select("rid", "v.headcode", "v.toc", "v.ssd", "v.uid", "v.train_cat")


def current_vertices(parsed: DataFrame) -> DataFrame:
    """Live schedule vertices after upserts and deactivations (one pass over the messages)."""
    return latest_vertices(vertex_events(parsed))


def last_deactivations(events: DataFrame) -> DataFrame:
    """``rid, gone``: the position of every train's last tombstone."""
    return events.where(~F.col("v.live")).groupBy("rid").agg(F.max("at").alias("gone"))


def latest_edges(edges: DataFrame, events: DataFrame) -> DataFrame:
    """Latest version of every edge of a live train, among those sent after the train's last deactivation.

    Deleting a vertex deletes its edges, so a train that is scheduled again
    starts without any.
    """
    cols = [c for c in edges.columns if c != "edge_id"]
    at = F.struct("msg_ts", "seq")
    after = (edges.join(last_deactivations(events), "rid", "left").where(F.col("gone").isNull() | (at > F.col("gone")))
             .drop("gone"))
    # max_by aggregates partially before the shuffle: a hot edge id costs no single task
    latest = after.groupBy("edge_id").agg(F.max_by(F.struct(*cols), at).alias("e")).select("edge_id", "e.*")
    return latest.join(latest_vertices(events).select("rid"), "rid", "left_semi")


def current_edges(parsed: DataFrame) -> DataFrame:
    """Live forecast edges."""
    return latest_edges(forecast_edges(parsed), vertex_events(parsed))


def current_schedule_edges(parsed: DataFrame) -> DataFrame:
    """Live schedule edges."""
    return latest_edges(schedule_edges(parsed), vertex_events(parsed))
