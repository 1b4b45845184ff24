"""Nested documents: rail push-feed XML → graph tables; geo-tagged tweets."""

from __future__ import annotations

from pyspark.sql import functions as F

from kestrel.functions.geo import haversine_miles, haversine_sql
from kestrel.operators import rail as RL
from kestrel.plans.registry import query
from kestrel.session import scratch_path
from kestrel.sources import tweets as TW
from kestrel.sources.railfeed import rail_xml


def _parsed(spark, sf_dir):
    return RL.parse_messages(rail_xml(spark, sf_dir))


def _hhmm(off: str) -> str:
    return f"strftime(ts + to_minutes(CAST({off} AS BIGINT)), '%H:%M')"


def _mins(a: str, b: str) -> str:
    m = lambda s: f"(CAST(substr({s}, 1, 2) AS INTEGER) * 60 + CAST(substr({s}, 4, 2) AS INTEGER))"
    d = f"({m(b)} - {m(a)})"
    return f"(CASE WHEN {d} > 720 THEN {d} - 1440 WHEN {d} < -720 THEN {d} + 1440 ELSE {d} END)"


_EV = """ev AS (SELECT event_id AS e, ts, user_id, 'R' || CAST(user_id AS VARCHAR) AS rid,
    strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS msg_ts,
    CASE WHEN event_type IN ('view', 'click', 'purchase') THEN 'TS' WHEN event_type = 'signup' THEN 'schedule'
         ELSE 'deactivated' END AS kind FROM events)"""

_LOC = """loc AS (SELECT e, rid, msg_ts, j, ts + to_minutes(CAST(j * 10 AS BIGINT)) AS base FROM (
        SELECT *, unnest(range(1 + e % 3)) AS j FROM ev WHERE kind = 'TS') x),
    lf AS (SELECT e, rid, msg_ts, 'T' || CAST((e + j) % 40 AS VARCHAR) AS tpl,
        CASE WHEN j <> 1 THEN strftime(base, '%H:%M') END AS wta,
        CASE WHEN j <> 1 THEN strftime(base + to_minutes(1), '%H:%M') END AS wtd,
        CASE WHEN j = 1 THEN strftime(base, '%H:%M') END AS wtp,
        CASE WHEN j <> 1 AND (e // 3) % 3 = 0 THEN strftime(base + to_minutes(CAST(e % 6 AS BIGINT)), '%H:%M') END AS aat,
        CASE WHEN j <> 1 AND (e // 3) % 3 = 1 THEN (CASE WHEN e % 2 = 0 THEN strftime(base + to_minutes(2), '%H:%M')
             ELSE strftime(base + to_minutes(CAST(e % 5 AS BIGINT)), '%H:%M') END) END AS aet,
        CAST(NULL AS VARCHAR) AS dat,
        CASE WHEN j <> 1 THEN strftime(base + to_minutes(CAST(1 + e % 4 AS BIGINT)), '%H:%M') END AS det,
        CAST(NULL AS VARCHAR) AS pat,
        CASE WHEN j = 1 THEN strftime(base + to_minutes(CAST(e % 4 AS BIGINT)), '%H:%M') END AS pet,
        CASE WHEN j <> 1 THEN CAST(e % 12 AS VARCHAR) END AS platform,
        CASE WHEN j <> 1 THEN 'P' END AS platsrc FROM loc),
    fe AS (SELECT rid || tpl AS edge_id, rid, tpl, msg_ts, e AS seq, wta, wtd, wtp, aat, aet, dat, det, pat, pet,
        platform, platsrc,
        coalesce(""" + _mins("wta", "coalesce(aat, aet)") + """, 0) AS ad,
        coalesce(""" + _mins("wtd", "coalesce(dat, det)") + """, 0) AS dd,
        coalesce(""" + _mins("wtp", "coalesce(pat, pet)") + """, 0) AS pd FROM lf)"""

_FE_COLS = "edge_id, rid, tpl, msg_ts, seq, wta, wtd, wtp, aat, aet, dat, det, pat, pet, platform, platsrc, ad, dd, pd"
_FE_SEL = _FE_COLS + ", (ad > 1 OR dd > 1 OR pd > 1) AS delayed"

_SV = """sv AS (SELECT rid, printf('1A%02d', e % 100) AS headcode, 'SW' AS toc, strftime(ts, '%Y-%m-%d') AS ssd,
    'U' || CAST(user_id AS VARCHAR) AS uid, 'OO' AS train_cat, msg_ts, e AS seq FROM ev WHERE kind = 'schedule')"""

_LIVE = """latest AS (SELECT rid, arg_max(kind, (msg_ts, e)) AS kind, arg_max(e, (msg_ts, e)) AS seq
        FROM ev WHERE kind IN ('schedule', 'deactivated') GROUP BY rid),
    live AS (SELECT sv.* FROM sv JOIN latest l ON sv.rid = l.rid AND sv.seq = l.seq WHERE l.kind = 'schedule')"""


@query("rail_parse_xml", "WITH " + _EV + """
    SELECT msg_ts, e AS seq, kind, rid, 'src' || CAST(e % 3 AS VARCHAR) AS request_source, 'TD' AS update_origin,
           CASE WHEN kind = 'TS' THEN CAST(1 + e % 3 AS INTEGER) END AS n_locations,
           CASE WHEN kind = 'schedule' THEN CAST(2 + e % 3 + CASE WHEN e % 2 = 0 THEN 1 ELSE 0 END AS INTEGER) END
             AS n_points
    FROM ev""")
def rail_parse_xml(spark, sf_dir):
    p = _parsed(spark, sf_dir)
    s = F.col("msg.uR.schedule")
    n_points = sum(F.coalesce(F.size(s[t]), F.lit(0)) for t in RL.POINT_TYPES)
    return RL.message_header(p, [
        F.when(F.col("msg.uR.TS").isNotNull(), F.size("msg.uR.TS.Location")).alias("n_locations"),
        F.when(s.isNotNull(), n_points).alias("n_points")])


@query("rail_forecast_edges", "WITH " + _EV + ", " + _LOC + " SELECT " + _FE_SEL + " FROM fe")
def rail_forecast_edges(spark, sf_dir):
    return RL.forecast_edges(_parsed(spark, sf_dir))


@query("rail_schedule_vertices", "WITH " + _EV + ", " + _SV + " SELECT * FROM sv")
def rail_schedule_vertices(spark, sf_dir):
    return RL.schedule_vertices(_parsed(spark, sf_dir))


_SCHEDULE_EDGES = """WITH
    pts AS (
      SELECT e, rid, msg_ts, ts, 'OR' AS type, 'T' || CAST(e % 40 AS VARCHAR) AS tpl, 'TB' AS act,
             NULL AS pta, """ + _hhmm("0") + """ AS ptd, NULL AS wta, """ + _hhmm("0") + """ AS wtd, NULL AS wtp
      FROM ev WHERE kind = 'schedule'
      UNION ALL
      SELECT e, rid, msg_ts, ts, 'IP', 'T' || CAST((e + 1 + k) % 40 AS VARCHAR), 'T', NULL, NULL,
             strftime(ts + to_minutes(CAST((k + 1) * 10 AS BIGINT)), '%H:%M'),
             strftime(ts + to_minutes(CAST((k + 1) * 10 + 1 AS BIGINT)), '%H:%M'), NULL
      FROM (SELECT *, unnest(range(e % 3)) AS k FROM ev WHERE kind = 'schedule') x
      UNION ALL
      SELECT e, rid, msg_ts, ts, 'PP', 'P' || CAST(e % 7 AS VARCHAR), NULL, NULL, NULL, NULL, NULL, """ + _hhmm("25") + """
      FROM ev WHERE kind = 'schedule' AND e % 2 = 0
      UNION ALL
      SELECT e, rid, msg_ts, ts, 'DT', 'T' || CAST((e + 5) % 40 AS VARCHAR), 'TF', """ + _hhmm("40") + """, NULL,
             """ + _hhmm("40") + """, NULL, NULL
      FROM ev WHERE kind = 'schedule')
    SELECT tpl || rid AS edge_id, rid, tpl, type, CAST(pta AS VARCHAR) AS pta, CAST(ptd AS VARCHAR) AS ptd,
           CAST(wta AS VARCHAR) AS wta, CAST(wtd AS VARCHAR) AS wtd, CAST(wtp AS VARCHAR) AS wtp,
           CAST(act AS VARCHAR) AS act, msg_ts, e AS seq FROM pts"""


@query("rail_schedule_edges", "WITH " + _EV + " " + _SCHEDULE_EDGES.replace("WITH", ",", 1))
def rail_schedule_edges(spark, sf_dir):
    return RL.schedule_edges(_parsed(spark, sf_dir))


@query("rail_current_state", "WITH " + _EV + ", " + _SV + ", " + _LIVE + """
    SELECT rid, headcode, toc, ssd, uid, train_cat FROM live""")
def rail_current_state(spark, sf_dir):
    return RL.current_vertices(_parsed(spark, sf_dir))


# An edge lives if its train's newest vertex message is a schedule, no deactivation of the train follows the edge's
# message, and no newer message carries the same edge.
def _live_edge(t: str) -> str:
    return f"""WHERE EXISTS (SELECT 1 FROM live WHERE live.rid = {t}.rid)
      AND NOT EXISTS (SELECT 1 FROM ev d WHERE d.kind = 'deactivated' AND d.rid = {t}.rid
                      AND (d.msg_ts > {t}.msg_ts OR (d.msg_ts = {t}.msg_ts AND d.e > {t}.seq)))
      AND NOT EXISTS (SELECT 1 FROM {t} n WHERE n.edge_id = {t}.edge_id
                      AND (n.msg_ts > {t}.msg_ts OR (n.msg_ts = {t}.msg_ts AND n.seq > {t}.seq)))"""


@query("rail_current_edges", "WITH " + _EV + ", " + _LOC + ", " + _SV + ", " + _LIVE + """
    SELECT """ + _FE_SEL + " FROM fe " + _live_edge("fe"))
def rail_current_edges(spark, sf_dir):
    return RL.current_edges(_parsed(spark, sf_dir))


@query("rail_current_schedule_edges", "WITH " + _EV + ", " + _SV + ", " + _LIVE + ", se AS (" + _SCHEDULE_EDGES + """)
    SELECT edge_id, rid, tpl, type, pta, ptd, wta, wtd, wtp, act, msg_ts, seq FROM se """ + _live_edge("se"))
def rail_current_schedule_edges(spark, sf_dir):
    return RL.current_schedule_edges(_parsed(spark, sf_dir))


# ---------------------------------------------------------------- tweets
_TW = """tw AS (SELECT doc_id AS id,
    strftime(TIMESTAMP '2024-01-01' + to_minutes(CAST(doc_id * 7 AS BIGINT)), '%a %b %d %H:%M:%S +0000 %Y') AS date,
    replace(text, chr(10), ' ') AS text,
    51.3 + CAST(doc_id % 83 AS DOUBLE) / 100.0 AS lat, -0.6 + CAST(doc_id % 89 AS DOUBLE) / 100.0 AS lon,
    doc_id % 97 AS "user" FROM documents),
    tr AS (SELECT id, date, text, [[lon - 0.01, lat - 0.01], [lon + 0.01, lat - 0.01], [lon + 0.01, lat + 0.01],
                  [lon - 0.01, lat + 0.01]] AS bounding_box, "user" FROM tw),
    geo AS (SELECT id, (bounding_box[1][2] + bounding_box[3][2]) / 2 AS clat,
                   (bounding_box[1][1] + bounding_box[3][1]) / 2 AS clon FROM tr),
    near AS (SELECT id, """ + haversine_sql("51.501", "-0.1275", "clat", "clon") + """ AS distance FROM geo)"""

# Search centre and radius of the original extraction (fixed values).
CENTRE_LAT, CENTRE_LON, RADIUS_MILES = 51.501, -0.1275, 10.0


def _tweets(spark, sf_dir):
    path = scratch_path(spark, "tweet-pages")
    TW.write_pages(TW.tweet_documents(spark, sf_dir), path)
    pages = TW.read_pages(spark, path)
    return TW.flatten(pages).dropDuplicates(["id"])   # boundary ids appear on two pages


def _near(flat):
    bb = F.col("bounding_box")
    clat = (bb[0][1] + bb[2][1]) / 2
    clon = (bb[0][0] + bb[2][0]) / 2
    d = haversine_miles(F.lit(CENTRE_LAT), F.lit(CENTRE_LON), clat, clon)
    return flat.select("id", d.alias("distance")).where(F.col("distance") <= RADIUS_MILES)


@query("tweets_flatten", "WITH " + _TW + " SELECT id, date, text, bounding_box, \"user\" FROM tr")
def tweets_flatten(spark, sf_dir):
    flat = _tweets(spark, sf_dir)
    out = scratch_path(spark, "tweets-json")
    flat.write.mode("overwrite").json(out)            # the extraction's JSON output
    return spark.read.schema(flat.schema).json(out)


@query("geo_radius_filter", "WITH " + _TW + " SELECT id, round(distance, 6) AS distance FROM near WHERE distance <= 10.0")
def geo_radius_filter(spark, sf_dir):
    return _near(_tweets(spark, sf_dir)).select("id", F.round("distance", 6).alias("distance"))


@query("keyset_page", "WITH " + _TW + """,
    ranked AS (SELECT id, row_number() OVER (ORDER BY id DESC) - 1 AS pos FROM near WHERE distance <= 10.0),
    paged AS (SELECT id, pos, pos // 99 AS page FROM ranked
              UNION ALL SELECT id, pos, pos // 99 - 1 FROM ranked WHERE pos > 0 AND pos % 99 = 0)
    SELECT CAST(page AS BIGINT) AS page, count(*) AS n, min(id) AS next_max_id, max(id) AS max_id FROM paged GROUP BY 1""")
def keyset_page(spark, sf_dir):
    """Search pages of 100, newest first; a page starts at the cursor, the smallest id of the page before."""
    return TW.keyset_pages(_near(_tweets(spark, sf_dir)), "id", 100)
