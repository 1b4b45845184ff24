"""Mileage family: dimension joins, ping cleaning, dedupe, segments, totals."""

from __future__ import annotations

from pyspark.sql import functions as F

from kestrel.functions.geo import haversine_sql, speed_sql, vincenty_sql
from kestrel.operators import mileage as M
from kestrel.operators.ranges import global_index
from kestrel.operators.sequence import row_index
from kestrel.plans.registry import query
from kestrel.sources import tables as T

V = ("pings", "vehicles", "fleets")

# Shared oracle CTEs: the same pipeline written in SQL.
_PIPE = """
fd AS (SELECT v.id, v."number" AS vehicle_number, v.class, f.fleet_id
       FROM vehicles v JOIN fleets f ON v.class = f.class),
cl AS (SELECT fd.vehicle_number, fd.class, fd.fleet_id, p.lat, p.lon, p.ts, p.speed,
              epoch_us(p.ts) // 1000000 AS unix_ts
       FROM pings p JOIN fd ON p.vehicle = fd.id WHERE p.lat <> 0),
cr AS (SELECT *, make_timestamp(CAST(round(unix_ts / 60.0) * 60 AS BIGINT) * 1000000) AS ts_round FROM cl),
dd AS (SELECT * FROM cr QUALIFY lat = min(lat) OVER (PARTITION BY vehicle_number, ts_round)),
sq AS (SELECT *, lead(lat) OVER w AS lat_next, lead(lon) OVER w AS lon_next,
              lead(unix_ts) OVER w AS unix_ts_next, lead(ts_round) OVER w AS ts_round_next
       FROM dd WINDOW w AS (PARTITION BY vehicle_number ORDER BY ts, lon, lat)),
sg AS (SELECT *, """ + haversine_sql("lat", "lon", "lat_next", "lon_next") + """ AS distance
       FROM sq WHERE lat_next IS NOT NULL)
"""


def _segments(spark, sf_dir, keep_zero=False):
    fd = M.fleet_dimension(T.vehicles(spark, sf_dir), T.fleets(spark, sf_dir))
    clean = M.clean_pings(T.pings(spark, sf_dir), fd)
    return M.segments(M.dedupe_min_latitude(clean), keep_zero=keep_zero)


@query("vehicle_mileage", T.with_views(
    "WITH " + _PIPE + """
    SELECT vehicle_number, round(sum(distance), 4) AS miles FROM sg WHERE distance <> 0
    GROUP BY vehicle_number""", *V))
def vehicle_mileage(spark, sf_dir):
    m = M.vehicle_mileage(_segments(spark, sf_dir))
    return m.select("vehicle_number", F.round("miles", 4).alias("miles"))


@query("segments", T.with_views(
    "WITH " + _PIPE + """
    SELECT vehicle_number, class, lat, lon, unix_ts, ts_round, speed, lat_next, lon_next,
           unix_ts_next, ts_round_next, round(distance, 6) AS distance,
           round(""" + speed_sql("distance", "unix_ts", "unix_ts_next") + """, 4) AS speed_calc
    FROM sg WHERE distance <> 0""", *V))
def segments_q(spark, sf_dir):
    s = _segments(spark, sf_dir)
    return s.select("vehicle_number", "class", "lat", "lon", "unix_ts", "ts_round", "speed",
                    "lat_next", "lon_next", "unix_ts_next", "ts_round_next",
                    F.round("distance", 6).alias("distance"), F.round("speed_calc", 4).alias("speed_calc"))


@query("next_position", T.with_views(
    "WITH " + _PIPE + """
    SELECT vehicle_number, ts, lat_next, lon_next, unix_ts_next FROM sq""", *V))
def next_position(spark, sf_dir):
    fd = M.fleet_dimension(T.vehicles(spark, sf_dir), T.fleets(spark, sf_dir))
    d = M.dedupe_min_latitude(M.clean_pings(T.pings(spark, sf_dir), fd))
    from kestrel.operators.sequence import next_in_sequence
    s = next_in_sequence(d, "vehicle_number", "bucket", ["ts", "lon", "lat"], ["lat", "lon", "unix_ts"])
    return s.select("vehicle_number", "ts", "lat_next", "lon_next", "unix_ts_next")


@query("haversine_miles", T.with_views(
    "WITH " + _PIPE + """
    SELECT vehicle_number, ts, round(distance, 6) AS distance FROM sg""", *V))
def haversine_q(spark, sf_dir):
    s = _segments(spark, sf_dir, keep_zero=True)
    return s.select("vehicle_number", "ts", F.round("distance", 6).alias("distance"))


@query("vincenty_miles", T.with_views(
    "WITH " + _PIPE + """
    SELECT vehicle_number, ts, round(""" + vincenty_sql("lat", "lon", "lat_next", "lon_next") + """, 6) AS vincenty,
           round(abs(""" + vincenty_sql("lat", "lon", "lat_next", "lon_next") + """ - distance), 6) AS gap
    FROM sg""", *V))
def vincenty_q(spark, sf_dir):
    s = M.great_circle_check(_segments(spark, sf_dir, keep_zero=True))
    return s.select("vehicle_number", "ts", F.round("vincenty", 6).alias("vincenty"),
                    F.round(F.abs(F.col("vincenty") - F.col("distance")), 6).alias("gap"))


@query("segment_speed", T.with_views(
    "WITH " + _PIPE + """
    SELECT vehicle_number, ts, unix_ts, unix_ts_next,
           round(""" + speed_sql("distance", "unix_ts", "unix_ts_next") + """, 4) AS speed_calc
    FROM sg""", *V))
def segment_speed(spark, sf_dir):
    s = _segments(spark, sf_dir, keep_zero=True)
    return s.select("vehicle_number", "ts", "unix_ts", "unix_ts_next", F.round("speed_calc", 4).alias("speed_calc"))


@query("dim_join_chain", T.with_views("""
    SELECT v.id, v."number" AS vehicle_number, v.class, f.fleet_id
    FROM vehicles v JOIN fleets f ON v.class = f.class""", "vehicles", "fleets"))
def dim_join_chain(spark, sf_dir):
    return M.fleet_dimension(T.vehicles(spark, sf_dir), T.fleets(spark, sf_dir))


@query("clean_pings", T.with_views(
    "WITH " + _PIPE + """
    SELECT vehicle_number, class, fleet_id, lat, lon, ts, speed, unix_ts, ts_round FROM cr""", *V))
def clean_pings(spark, sf_dir):
    fd = M.fleet_dimension(T.vehicles(spark, sf_dir), T.fleets(spark, sf_dir))
    return M.clean_pings(T.pings(spark, sf_dir), fd).drop("bucket")


@query("dedupe_min_latitude", T.with_views(
    "WITH " + _PIPE + """
    SELECT vehicle_number, ts_round, lat, lon, ts FROM dd""", *V))
def dedupe_min_latitude(spark, sf_dir):
    fd = M.fleet_dimension(T.vehicles(spark, sf_dir), T.fleets(spark, sf_dir))
    d = M.dedupe_min_latitude(M.clean_pings(T.pings(spark, sf_dir), fd))
    return d.select("vehicle_number", "ts_round", "lat", "lon", "ts")


@query("group_min", T.with_views(
    "WITH " + _PIPE + """
    SELECT vehicle_number, ts_round, min(lat) AS min_latitude FROM cr GROUP BY vehicle_number, ts_round""", *V))
def group_min(spark, sf_dir):
    fd = M.fleet_dimension(T.vehicles(spark, sf_dir), T.fleets(spark, sf_dir))
    c = M.clean_pings(T.pings(spark, sf_dir), fd)
    return c.groupBy("vehicle_number", "ts_round").agg(F.min("lat").alias("min_latitude"))


@query("group_count_desc", T.with_views(
    "WITH " + _PIPE + """
    SELECT vehicle_number, count(*) AS "count" FROM dd GROUP BY vehicle_number ORDER BY "count" DESC, vehicle_number""", *V))
def group_count_desc(spark, sf_dir):
    fd = M.fleet_dimension(T.vehicles(spark, sf_dir), T.fleets(spark, sf_dir))
    d = M.dedupe_min_latitude(M.clean_pings(T.pings(spark, sf_dir), fd))
    return d.groupBy("vehicle_number").count().orderBy(F.desc("count"), "vehicle_number")


@query("vehicle_list", T.with_views(
    "WITH " + _PIPE + """,
    vc AS (SELECT vehicle_number AS vn, count(*) AS n FROM dd GROUP BY vehicle_number)
    SELECT DISTINCT fd.vehicle_number, fd.class FROM vc LEFT OUTER JOIN fd ON vc.vn = fd.vehicle_number
    WHERE fd.class BETWEEN 5 AND 15""", *V))
def vehicle_list(spark, sf_dir):
    fd = M.fleet_dimension(T.vehicles(spark, sf_dir), T.fleets(spark, sf_dir))
    d = M.dedupe_min_latitude(M.clean_pings(T.pings(spark, sf_dir), fd))
    return M.vehicle_list(d, fd, 5, 15)


@query("semi_join", T.with_views(
    "WITH " + _PIPE + """,
    vl AS (SELECT DISTINCT vehicle_number FROM fd WHERE class BETWEEN 5 AND 15)
    SELECT vehicle_number, ts, lat, lon FROM dd WHERE vehicle_number IN (SELECT vehicle_number FROM vl)""", *V))
def semi_join(spark, sf_dir):
    fd = M.fleet_dimension(T.vehicles(spark, sf_dir), T.fleets(spark, sf_dir))
    d = M.dedupe_min_latitude(M.clean_pings(T.pings(spark, sf_dir), fd))
    vl = fd.where(F.col("class").between(5, 15)).select("vehicle_number")
    return d.join(vl, "vehicle_number", "left_semi").select("vehicle_number", "ts", "lat", "lon")


@query("left_outer_join", T.with_views("""
    SELECT p.vehicle, p.ts, v."number" AS vehicle_number, v.class
    FROM pings p LEFT OUTER JOIN vehicles v ON p.vehicle = v.id""", "pings", "vehicles"))
def left_outer_join(spark, sf_dir):
    p, v = T.pings(spark, sf_dir), T.vehicles(spark, sf_dir)
    return (p.join(v, p["vehicle"] == v["id"], "left_outer")
            .select("vehicle", "ts", F.col("number").alias("vehicle_number"), "class"))


@query("row_index", T.with_views(
    "WITH " + _PIPE + """
    SELECT vehicle_number, ts, row_number() OVER (PARTITION BY vehicle_number ORDER BY ts, lon, lat) - 1 AS "index"
    FROM dd""", *V))
def row_index_q(spark, sf_dir):
    fd = M.fleet_dimension(T.vehicles(spark, sf_dir), T.fleets(spark, sf_dir))
    d = M.dedupe_min_latitude(M.clean_pings(T.pings(spark, sf_dir), fd))
    r = row_index(d, "vehicle_number", ["ts", "lon", "lat"], bucket="bucket")
    return r.select("vehicle_number", "ts", F.col("index").cast("long").alias("index"))


@query("row_index_global", T.with_views(
    "WITH " + _PIPE + """
    SELECT vehicle_number, ts, lat, lon, row_number() OVER (ORDER BY vehicle_number, ts, lon, lat) - 1 AS "index"
    FROM dd""", *V))
def row_index_global(spark, sf_dir):
    """Position of every ping in the whole table sorted by vehicle and time."""
    fd = M.fleet_dimension(T.vehicles(spark, sf_dir), T.fleets(spark, sf_dir))
    d = M.dedupe_min_latitude(M.clean_pings(T.pings(spark, sf_dir), fd))
    return global_index(d.select("vehicle_number", "ts", "lat", "lon"), ["vehicle_number", "ts", "lon", "lat"])


@query("filter_day", T.with_views("""
    SELECT vehicle, ts, lat, lon FROM pings
    WHERE CAST(make_timestamp(CAST(round((epoch_us(ts) // 1000000) / 60.0) * 60 AS BIGINT) * 1000000) AS DATE)
          = DATE '2024-01-10'""", "pings"))
def filter_day(spark, sf_dir):
    from kestrel.functions.timecols import on_rounded_day
    return T.pings(spark, sf_dir).where(on_rounded_day("ts", "2024-01-10")).select("vehicle", "ts", "lat", "lon")
