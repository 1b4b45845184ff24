"""Rail push-feed fixture: one XML message per event, synthesised with Spark SQL.

Event types map to message kinds (view/click/purchase → train status,
signup → schedule, error → deactivation); the train id is per user, so the
same train receives upserts, forecasts and tombstones over time.  Namespace
prefixes are used as in the real feed (ignored by the parser).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kestrel.sources.tables import table


def _hhmm(offset: str) -> str:
    return f"date_format(ts + make_dt_interval(0, 0, CAST({offset} AS INT), 0), 'HH:mm')"


def _location(j: int) -> str:
    base = f"{j * 10}"
    tpl = f"concat('T', CAST((event_id + {j}) % 40 AS STRING))"
    if j == 1:
        body = (f"concat('<fc:Location tpl=\"', {tpl}, '\" wtp=\"', {_hhmm(base)}, '\"><fc:pass et=\"', "
                f"{_hhmm(f'{base} + event_id % 4')}, '\"/></fc:Location>')")
    else:
        arr = (f"CASE (event_id DIV 3) % 3 WHEN 0 THEN concat('<fc:arr at=\"', {_hhmm(f'{base} + event_id % 6')}, "
               f"'\" src=\"TD\"/>') WHEN 1 THEN concat('<fc:arr et=\"', {_hhmm(f'{base} + event_id % 5')}, '\"', "
               f"CASE WHEN event_id % 2 = 0 THEN concat(' wet=\"', {_hhmm(f'{base} + 2')}, '\"') ELSE '' END, "
               f"' src=\"Forecast\"/>') ELSE '' END")
        body = (f"concat('<fc:Location tpl=\"', {tpl}, '\" wta=\"', {_hhmm(base)}, '\" wtd=\"', "
                f"{_hhmm(f'{base} + 1')}, '\">', {arr}, '<fc:dep et=\"', {_hhmm(f'{base} + 1 + event_id % 4')}, "
                f"'\"/><fc:plat platsrc=\"P\">', CAST(event_id % 12 AS STRING), '</fc:plat></fc:Location>')")
    return f"CASE WHEN {j} < 1 + event_id % 3 THEN {body} ELSE '' END"


_TS = ("concat('<TS rid=\"R', CAST(user_id AS STRING), '\" uid=\"U', CAST(user_id AS STRING), '\" ssd=\"', "
       "date_format(ts, 'yyyy-MM-dd'), '\">', " + ", ".join(_location(j) for j in range(3)) + ", '</TS>')")

_IP = " ".join(
    f"CASE WHEN {k} < event_id % 3 THEN concat('<sc:IP tpl=\"T', CAST((event_id + {1 + k}) % 40 AS STRING), "
    f"'\" act=\"T\" wta=\"', {_hhmm(str((k + 1) * 10))}, '\" wtd=\"', {_hhmm(str((k + 1) * 10 + 1))}, '\"/>') "
    f"ELSE '' END," for k in range(2))

_SCHEDULE = (
    "concat('<schedule rid=\"R', CAST(user_id AS STRING), '\" uid=\"U', CAST(user_id AS STRING), "
    "'\" trainId=\"', format_string('1A%02d', event_id % 100), '\" toc=\"SW\" ssd=\"', date_format(ts, 'yyyy-MM-dd'), "
    "'\" trainCat=\"OO\">', "
    f"concat('<sc:OR tpl=\"T', CAST(event_id % 40 AS STRING), '\" act=\"TB\" wtd=\"', {_hhmm('0')}, '\" ptd=\"', "
    f"{_hhmm('0')}, '\"/>'), {_IP} "
    f"CASE WHEN event_id % 2 = 0 THEN concat('<sc:PP tpl=\"P', CAST(event_id % 7 AS STRING), '\" wtp=\"', "
    f"{_hhmm('25')}, '\"/>') ELSE '' END, "
    f"concat('<sc:DT tpl=\"T', CAST((event_id + 5) % 40 AS STRING), '\" act=\"TF\" wta=\"', {_hhmm('40')}, "
    f"'\" pta=\"', {_hhmm('40')}, '\"/>'), '</schedule>')")

_MESSAGE = (
    "concat('<Pport xmlns:fc=\"urn:rail:forecasts\" xmlns:sc=\"urn:rail:schedules\" ts=\"', "
    "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\"), '\" seq=\"', CAST(event_id AS STRING), "
    "'\"><uR updateOrigin=\"TD\" requestSource=\"src', CAST(event_id % 3 AS STRING), '\">', "
    "CASE WHEN event_type IN ('view', 'click', 'purchase') THEN " + _TS +
    " WHEN event_type = 'signup' THEN " + _SCHEDULE +
    " ELSE concat('<deactivated rid=\"R', CAST(user_id AS STRING), '\"/>') END, '</uR></Pport>')")


def rail_xml(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``rail_xml(value string)``: one gzip-free message body per event."""
    return table(spark, sf_dir, "events").selectExpr(f"{_MESSAGE} AS value")
