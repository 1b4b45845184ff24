"""Scalar functions and projections: strings, JSON, date/time, math, nulls, arrays."""

from __future__ import annotations

from pyspark.sql import functions as F

from kestrel.functions.parse import name_fields, split_literal, typed_customer
from kestrel.functions.timecols import hhmm_minutes_between as minutes_between, round_to_minute
from kestrel.plans.registry import query
from kestrel.sources import tables as T

_SPLIT9 = "string_split(line, '@|')"


@query("split_fields", T.with_views(f"""
    SELECT event_id, CAST(len({_SPLIT9}) AS INTEGER) AS n_fields, {_SPLIT9}[5] AS nino, {_SPLIT9}[6] AS housing
    FROM customer_lines""", "customer_lines"))
def split_fields(spark, sf_dir):
    parts = split_literal("line", T.CUSTOMER_DELIM)
    l = T.customer_lines(spark, sf_dir)
    return l.select("event_id", F.size(parts).alias("n_fields"),
                    F.try_element_at(parts, F.lit(5)).alias("nino"), F.try_element_at(parts, F.lit(6)).alias("housing"))


_NAMED = ", ".join(f"{_SPLIT9}[{i + 1}] AS \"{n}\"" for i, n in enumerate(T.CUSTOMER_FIELDS))


@query("customer_records", T.with_views(f"""SELECT event_id, {_NAMED} FROM customer_lines""", "customer_lines"))
def customer_records(spark, sf_dir):
    l = T.customer_lines(spark, sf_dir).withColumn("_p", split_literal("line", T.CUSTOMER_DELIM))
    return name_fields(l, "_p", T.CUSTOMER_FIELDS, keep=["event_id"])


@query("typed_projection", T.with_views(f"""
    WITH n AS (SELECT event_id, {_NAMED} FROM customer_lines)
    SELECT event_id, firstname, surname, nino, address, postcode,
           make_timestamp(CAST(tstamp AS BIGINT) * 1000000) AS tstamp, CAST(dob AS DATE) AS dob,
           CAST("housingCosts" AS DOUBLE) AS "housingCosts", CAST("childCareCosts" AS DOUBLE) AS "childCareCosts"
    FROM n""", "customer_lines"))
def typed_projection(spark, sf_dir):
    l = T.customer_lines(spark, sf_dir).withColumn("_p", split_literal("line", T.CUSTOMER_DELIM))
    return typed_customer(name_fields(l, "_p", T.CUSTOMER_FIELDS, keep=["event_id"]))


@query("constant_projection", T.with_views("""
    SELECT 'wordcount' AS field, string_split(line, '@|')[1] AS val FROM customer_lines""", "customer_lines"))
def constant_projection(spark, sf_dir):
    l = T.customer_lines(spark, sf_dir)
    return l.select(F.lit("wordcount").alias("field"), F.try_element_at(split_literal("line", "@|"), F.lit(1)).alias("val"))


@query("scalar_strings", r"""
    SELECT doc_id,
           regexp_replace(replace(text, chr(10), ' '), '[^\x00-\x7F]', '', 'g') AS ascii_text,
           CAST(len(string_split(text, ' ')) AS INTEGER) AS n_fields,
           concat_ws('|', lang, "source") AS lang_source,
           lang || '-' || CAST(doc_id AS VARCHAR) AS doc_key,
           trim('  ' || "source" || '  ') AS trimmed,
           translate(lang, 'aeiou', 'AEIOU') AS lang_upper_vowels
    FROM documents""")
def scalar_strings(spark, sf_dir):
    d = T.table(spark, sf_dir, "documents")
    return d.select(
        "doc_id",
        F.regexp_replace(F.replace(F.col("text"), F.lit("\n"), F.lit(" ")), r"[^\x00-\x7F]", "").alias("ascii_text"),
        F.size(split_literal("text", " ")).alias("n_fields"),
        F.concat_ws("|", "lang", "source").alias("lang_source"),
        F.concat(F.col("lang"), F.lit("-"), F.col("doc_id").cast("string")).alias("doc_key"),
        F.trim(F.concat(F.lit("  "), F.col("source"), F.lit("  "))).alias("trimmed"),
        F.translate("lang", "aeiou", "AEIOU").alias("lang_upper_vowels"))


@query("scalar_json", """
    SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
           CAST(json_object('event_id', event_id, 'k', CAST(json_extract(props, '$.k') AS BIGINT)) AS VARCHAR) AS doc
    FROM events""")
def scalar_json(spark, sf_dir):
    e = T.table(spark, sf_dir, "events")
    parsed = e.select("event_id", F.from_json("props", "k BIGINT").alias("p"))
    return parsed.select("event_id", F.col("p.k").alias("k"),
                         F.to_json(F.struct("event_id", F.col("p.k").alias("k"))).alias("doc"))


@query("scalar_datetime", """
    WITH f AS (SELECT event_id, ts, strftime(ts, '%d/%m/%Y %H:%M:%S:%f') AS formatted,
                      epoch_us(ts) // 1000000 AS unix_ts FROM events)
    SELECT event_id, formatted,
           epoch_us(strptime(formatted, '%d/%m/%Y %H:%M:%S:%f')) // 1000000 AS parsed_unix,
           make_timestamp(CAST(round(unix_ts / 60.0) * 60 AS BIGINT) * 1000000) AS ts_round,
           strftime(make_timestamp(unix_ts * 1000000), '%Y-%m-%dT%H:%M:%S') AS iso,
           strptime(strftime(make_timestamp(unix_ts * 1000000), '%Y-%m-%dT%H:%M:%S') || '.000000',
                    '%Y-%m-%dT%H:%M:%S.%f') AS reparsed,
           substr(strftime(ts, '%Y-%m-%d %H:%M:%S'), 1, 10) AS day_text
    FROM f""")
def scalar_datetime(spark, sf_dir):
    e = T.table(spark, sf_dir, "events")
    fmt = "dd/MM/yyyy HH:mm:ss:SSSSSS"
    f = e.select("event_id", "ts", F.date_format("ts", fmt).alias("formatted"),
                 F.unix_timestamp("ts").alias("unix_ts"))
    iso = F.date_format(F.timestamp_seconds("unix_ts"), "yyyy-MM-dd'T'HH:mm:ss")
    return f.select(
        "event_id", "formatted",
        F.unix_timestamp("formatted", fmt).alias("parsed_unix"),
        round_to_minute("unix_ts").alias("ts_round"),
        iso.alias("iso"),
        F.try_to_timestamp(F.concat(iso, F.lit(".000000")), F.lit("yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
        .cast("timestamp_ntz").alias("reparsed"),
        F.substring(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), 1, 10).alias("day_text"))


@query("hhmm_minutes_between", """
    WITH t AS (SELECT event_id, strftime(ts, '%H:%M') AS first_hhmm,
                      strftime(make_timestamp((epoch_us(ts) // 1000000 + CAST(floor("value") AS BIGINT) * 60) * 1000000),
                               '%H:%M') AS second_hhmm FROM events),
    m AS (SELECT *, (CAST(substr(second_hhmm, 1, 2) AS INTEGER) * 60 + CAST(substr(second_hhmm, 4, 2) AS INTEGER))
                  - (CAST(substr(first_hhmm, 1, 2) AS INTEGER) * 60 + CAST(substr(first_hhmm, 4, 2) AS INTEGER)) AS d
          FROM t)
    SELECT event_id, first_hhmm, second_hhmm,
           CASE WHEN d > 720 THEN d - 1440 WHEN d < -720 THEN d + 1440 ELSE d END AS minutes
    FROM m""")
def hhmm_minutes_between(spark, sf_dir):
    e = T.table(spark, sf_dir, "events")
    second = F.date_format(F.timestamp_seconds(F.unix_timestamp("ts") + F.floor("value") * 60), "HH:mm")
    t = e.select("event_id", F.date_format("ts", "HH:mm").alias("first_hhmm"), second.alias("second_hhmm"))
    return t.withColumn("minutes", minutes_between("first_hhmm", "second_hhmm"))


@query("scalar_math", """
    SELECT event_id, round(sqrt("value"), 1) AS root_1dp, round(abs("value" - 100.0), 6) AS abs_dev,
           round(pow("value", 2), 6) AS sq, event_id % 10 AS digit,
           round(radians("value"), 9) AS rad, round(sin(radians("value")), 9) AS sine,
           round(cos(radians("value")), 9) AS cosine, round(atan2("value", 100.0), 9) AS angle
    FROM events""")
def scalar_math(spark, sf_dir):
    e = T.table(spark, sf_dir, "events")
    v = F.col("value")
    return e.select("event_id", F.round(F.sqrt(v), 1).alias("root_1dp"), F.round(F.abs(v - 100.0), 6).alias("abs_dev"),
                    F.round(F.pow(v, 2), 6).alias("sq"), F.pmod("event_id", F.lit(10)).alias("digit"),
                    F.round(F.radians(v), 9).alias("rad"), F.round(F.sin(F.radians(v)), 9).alias("sine"),
                    F.round(F.cos(F.radians(v)), 9).alias("cosine"), F.round(F.atan2(v, F.lit(100.0)), 9).alias("angle"))


@query("null_defaults", """
    SELECT d.doc_id, coalesce(l.quality, -1) AS quality, coalesce(l.toxic, 0) AS toxic,
           coalesce(CASE WHEN l.quality = 1 THEN 'good' END, d.lang, 'unknown') AS tag
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def null_defaults(spark, sf_dir):
    d = T.table(spark, sf_dir, "documents").select("doc_id", "lang")
    l = T.table(spark, sf_dir, "labels")
    j = d.join(l, "doc_id", "left")
    return j.select("doc_id", F.coalesce("quality", F.lit(-1)).alias("quality"),
                    F.coalesce("toxic", F.lit(0)).alias("toxic"),
                    F.coalesce(F.when(F.col("quality") == 1, F.lit("good")), F.col("lang"), F.lit("unknown")).alias("tag"))


@query("array_element", """
    SELECT vec_id, embedding[1] AS first_value, embedding[-1] AS last_value, CAST(len(embedding) AS INTEGER) AS dims
    FROM embeddings""")
def array_element(spark, sf_dir):
    e = T.table(spark, sf_dir, "embeddings")
    return e.select("vec_id", F.element_at("embedding", 1).alias("first_value"),
                    F.element_at("embedding", -1).alias("last_value"), F.size("embedding").alias("dims"))


@query("genres_array", """
    SELECT CAST(p_partkey AS INTEGER) AS item, p_name AS title,
           string_split(p_brand || '|' || replace(p_type, ' ', '|'), '|') AS genres FROM part""")
def genres_array(spark, sf_dir):
    p = T.table(spark, sf_dir, "part")
    g = F.concat(F.col("p_brand"), F.lit("|"), F.replace(F.col("p_type"), F.lit(" "), F.lit("|")))
    return p.select(F.col("p_partkey").cast("int").alias("item"), F.col("p_name").alias("title"),
                    split_literal(g, "|").alias("genres"))


@query("tab_tokens", """
    SELECT u.token FROM (SELECT unnest(string_split(CAST(p_partkey AS VARCHAR) || chr(9) || p_name, chr(9))) AS token
                         FROM part) u""")
def tab_tokens(spark, sf_dir):
    p = T.table(spark, sf_dir, "part")
    line = F.concat(F.col("p_partkey").cast("string"), F.lit("\t"), F.col("p_name"))
    return p.select(F.explode(split_literal(line, "\t")).alias("token"))
