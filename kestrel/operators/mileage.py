"""Vehicle mileage from position pings.

Plan: scan → dimension joins → clean + minute rounding → one ping per
vehicle-minute (minimum latitude) → successor ping → great-circle distance and
speed → sum per vehicle.  The dedupe window and the successor window share one
hash partitioning on ``(vehicle_number, bucket)``; no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kestrel.functions.geo import haversine_miles, speed_mph, vincenty_miles
from kestrel.functions.timecols import epoch_seconds, round_to_minute
from kestrel.operators.sequence import next_in_sequence

# Width of the work buckets of the per-vehicle windows (seconds).
DEFAULT_BUCKET_SECONDS = 3600


def fleet_dimension(vehicles: DataFrame, fleets: DataFrame) -> DataFrame:
    """``vehicles ⋈ fleets`` on class → ``id, vehicle_number, class, fleet_id``."""
    return (vehicles.join(fleets, "class")
            .select("id", F.col("number").alias("vehicle_number"), "class", "fleet_id"))


def clean_pings(pings: DataFrame, fleet_dim: DataFrame,
                bucket_seconds: int = DEFAULT_BUCKET_SECONDS) -> DataFrame:
    """Join pings to their vehicle, drop zero latitude, add epoch and minute columns."""
    p = pings.where(F.col("lat") != 0)
    j = p.join(fleet_dim, p["vehicle"] == fleet_dim["id"])
    j = j.select("vehicle_number", "class", "fleet_id", "lat", "lon", "ts", "speed",
                 epoch_seconds("ts").alias("unix_ts"))
    j = j.withColumn("ts_round", round_to_minute("unix_ts"))
    return j.withColumn("bucket", F.floor(F.unix_timestamp("ts_round") / bucket_seconds).cast("long"))


def dedupe_min_latitude(clean: DataFrame) -> DataFrame:
    """Keep the pings at the minimum latitude of their vehicle-minute (ties all kept).

    ``bucket`` is a function of ``ts_round``, so adding it to the partition keys
    does not change the groups but lets the next window reuse the shuffle.
    """
    w = Window.partitionBy("vehicle_number", "bucket", "ts_round")
    spread = clean.repartition("vehicle_number", "bucket")   # the one shuffle of the pipeline
    return (spread.withColumn("_min_lat", F.min("lat").over(w))
            .where(F.col("lat") == F.col("_min_lat")).drop("_min_lat"))


def segments(deduped: DataFrame, keep_zero: bool = False) -> DataFrame:
    """Consecutive ping pairs per vehicle with distance (miles) and speed (mph)."""
    s = next_in_sequence(deduped, key="vehicle_number", bucket="bucket",
                         order=["ts", "lon", "lat"], carry=["lat", "lon", "unix_ts", "ts_round"])
    s = s.where(F.col("lat_next").isNotNull())
    s = s.withColumn("distance", haversine_miles("lat", "lon", "lat_next", "lon_next"))
    s = s.withColumn("speed_calc", speed_mph("distance", "unix_ts", "unix_ts_next"))
    if not keep_zero:
        s = s.where(F.col("distance") != 0)
    return s


def vehicle_mileage(segs: DataFrame) -> DataFrame:
    """Total miles per vehicle (partial aggregation before the shuffle)."""
    return segs.groupBy("vehicle_number").agg(F.sum("distance").alias("miles"))


def vehicle_list(pings_full: DataFrame, fleet_dim: DataFrame, lo: int, hi: int) -> DataFrame:
    """Distinct vehicles that reported, whose class lies in ``[lo, hi]``.

    Written as a left outer join followed by a filter on the right side, as in
    the original job; Catalyst turns it into an inner join.
    """
    counts = pings_full.groupBy(F.col("vehicle_number").alias("vn")).count()
    dim = fleet_dim.select(F.col("vehicle_number").alias("d_vn"), F.col("class").alias("d_class"))
    j = counts.join(dim, counts["vn"] == dim["d_vn"], "left_outer")
    return (j.select(F.col("d_vn").alias("vehicle_number"), F.col("d_class").alias("class"))
            .where(F.col("class").between(lo, hi)).distinct())


def great_circle_check(segs: DataFrame) -> DataFrame:
    """Both distance formulas side by side (they agree to ~1e-9 miles)."""
    return segs.withColumn("vincenty", vincenty_miles("lat", "lon", "lat_next", "lon_next"))
