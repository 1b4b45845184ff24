"""Great-circle distance and speed as Spark column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the original job's for identical mileage:
# mean Earth radius in metres and the metres-to-statute-miles factor.
EARTH_RADIUS_M = 6371000.0
METRES_TO_MILES = 0.000621371


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def haversine_miles(lat1, lon1, lat2, lon2) -> Column:
    """Haversine distance in miles; ``a`` is clamped to [0, 1] against rounding."""
    lat1, lon1, lat2, lon2 = map(_c, (lat1, lon1, lat2, lon2))
    phi1, phi2 = F.radians(lat1), F.radians(lat2)
    dphi = F.radians(F.abs(lat2 - lat1))
    dlmb = F.radians(F.abs(lon2 - lon1))
    a = F.pow(F.sin(dphi / 2), 2) + F.cos(phi1) * F.cos(phi2) * F.pow(F.sin(dlmb / 2), 2)
    a = F.least(F.greatest(a, F.lit(0.0)), F.lit(1.0))
    c = 2 * F.atan2(F.sqrt(a), F.sqrt(1 - a))
    return c * EARTH_RADIUS_M * METRES_TO_MILES


def vincenty_miles(lat1, lon1, lat2, lon2) -> Column:
    """Spherical Vincenty (great-circle) distance in miles, radians throughout."""
    lat1, lon1, lat2, lon2 = map(_c, (lat1, lon1, lat2, lon2))
    phi1, phi2 = F.radians(lat1), F.radians(lat2)
    dlmb = F.radians(F.abs(lon2 - lon1))
    y = F.sqrt(F.pow(F.cos(phi2) * F.sin(dlmb), 2)
               + F.pow(F.cos(phi1) * F.sin(phi2) - F.sin(phi1) * F.cos(phi2) * F.cos(dlmb), 2))
    x = F.sin(phi1) * F.sin(phi2) + F.cos(phi1) * F.cos(phi2) * F.cos(dlmb)
    return F.atan2(y, x) * EARTH_RADIUS_M * METRES_TO_MILES


def speed_mph(distance_miles, t_from, t_to) -> Column:
    """Miles per hour over a segment; 0 when the two timestamps (seconds) coincide."""
    d, t0, t1 = map(_c, (distance_miles, t_from, t_to))
    dt = t1 - t0
    return F.when(dt == 0, F.lit(0.0)).otherwise(d / dt.cast("double") * 3600.0)


# SQL text of the same formulas, for the DuckDB oracle.
def haversine_sql(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    a = (f"least(greatest(pow(sin(radians(abs({lat2} - {lat1})) / 2), 2) + cos(radians({lat1})) * "
         f"cos(radians({lat2})) * pow(sin(radians(abs({lon2} - {lon1})) / 2), 2), 0.0), 1.0)")
    return f"(2 * atan2(sqrt({a}), sqrt(1 - {a})) * {EARTH_RADIUS_M} * {METRES_TO_MILES})"


def vincenty_sql(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    p1, p2, dl = f"radians({lat1})", f"radians({lat2})", f"radians(abs({lon2} - {lon1}))"
    y = (f"sqrt(pow(cos({p2}) * sin({dl}), 2) + pow(cos({p1}) * sin({p2}) - "
         f"sin({p1}) * cos({p2}) * cos({dl}), 2))")
    x = f"(sin({p1}) * sin({p2}) + cos({p1}) * cos({p2}) * cos({dl}))"
    return f"(atan2({y}, {x}) * {EARTH_RADIUS_M} * {METRES_TO_MILES})"


def speed_sql(d: str, t0: str, t1: str) -> str:
    return f"(CASE WHEN {t1} - {t0} = 0 THEN 0.0 ELSE {d} / CAST({t1} - {t0} AS DOUBLE) * 3600.0 END)"
