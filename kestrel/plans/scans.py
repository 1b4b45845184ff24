"""Sources and sinks: each query writes data derived from the driver tables in
the source format, reads it back with the typed reader and returns the rows."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel.operators import mileage as M
from kestrel.plans.registry import query
from kestrel.session import scratch_path
from kestrel.sinks import files as W
from kestrel.sinks.index import INDEX_SCHEMAS, read_index, write_index, write_index_batches
from kestrel.sources import readers as R
from kestrel.sources import tables as TB

_EPOCH = "epoch_us(ts) // 1000000"


@query("scan_ratings", TB.with_views(f"""
    SELECT "user", item, rating, {_EPOCH} AS ts, CAST(({_EPOCH}) % 10 AS INTEGER) AS bucket FROM ratings""",
    "ratings"))
def scan_ratings(spark, sf_dir):
    path = scratch_path(spark, "ratings-dat")
    r = TB.ratings(spark, sf_dir).withColumn("ts", F.unix_timestamp("ts"))
    W.write_delimited_text(r, path, ["user", "item", "rating", "ts"], "::")
    return R.read_ratings(spark, path, "::")


@query("scan_catalog", TB.with_views("""
    SELECT item, title, '::' AS variant FROM catalog UNION ALL SELECT item, title, 'tab' AS variant FROM catalog""",
    "catalog"))
def scan_catalog(spark, sf_dir):
    c = TB.catalog(spark, sf_dir)
    p1, p2 = scratch_path(spark, "movies-dat"), scratch_path(spark, "movies-tsv")
    W.write_delimited_text(c, p1, ["item", "title"], "::")
    W.write_delimited_text(c, p2, ["item", "title"], "\t")
    return (R.read_catalog(spark, p1, "::").withColumn("variant", F.lit("::"))
            .unionByName(R.read_catalog(spark, p2, "\t").withColumn("variant", F.lit("tab"))))


_GENRE_SCHEMA = T.StructType([T.StructField("item", T.IntegerType()), T.StructField("title", T.StringType()),
                              T.StructField("genres", T.StringType())])


@query("scan_header_csv", """
    SELECT CAST(p_partkey AS INTEGER) AS item, p_name AS title, p_brand || '|' || p_type AS genres FROM part""")
def scan_header_csv(spark, sf_dir):
    p = TB.table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("int").alias("item"), F.col("p_name").alias("title"),
        F.concat(F.col("p_brand"), F.lit("|"), F.col("p_type")).alias("genres"))
    path = scratch_path(spark, "movies-csv")
    W.write_csv(p, path, header=True, sep="\t")
    return R.read_header_csv(spark, path, _GENRE_SCHEMA, sep="\t")


@query("scan_dsv_infer", """
    SELECT CAST(c_custkey AS INTEGER) AS "RES", c_nationkey AS "RESGRP", c_mktsegment AS "SEGMENT" FROM customer""")
def scan_dsv_infer(spark, sf_dir):
    c = TB.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("RES"), F.col("c_nationkey").alias("RESGRP"), F.col("c_mktsegment").alias("SEGMENT"))
    path = scratch_path(spark, "resources-dsv")
    W.write_csv(c, path, header=True, sep="¦")
    return R.read_dsv_infer(spark, path, "¦")


_VEHICLE_SCHEMA = T.StructType([T.StructField("ID", T.LongType()), T.StructField("VehicleNumber", T.StringType())])


@query("scan_json", """SELECT c_custkey AS "ID", CAST(c_custkey AS INTEGER) AS "VehicleNumber" FROM customer""")
def scan_json(spark, sf_dir):
    v = TB.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("ID"), F.col("c_custkey").cast("string").alias("VehicleNumber"))
    path = scratch_path(spark, "vehicle-json")
    v.write.mode("overwrite").json(path)
    j = R.read_json_lines(spark, path, _VEHICLE_SCHEMA)
    return j.select("ID", F.col("VehicleNumber").cast("int").alias("VehicleNumber"))


@query("scan_parquet", TB.with_views("SELECT vehicle, ts, lat, lon, speed FROM pings", "pings"))
def scan_parquet(spark, sf_dir):
    path = scratch_path(spark, "channel-parquet")
    W.write_parquet(TB.pings(spark, sf_dir), path)
    return spark.read.parquet(path)


_QUOTED_SCHEMA = T.StructType([T.StructField("custkey", T.LongType()), T.StructField("label", T.StringType()),
                               T.StructField("balance", T.DoubleType())])


@query("scan_quoted_csv", """
    SELECT c_custkey AS custkey, c_name || ', ' || c_mktsegment AS label, c_acctbal AS balance FROM customer""")
def scan_quoted_csv(spark, sf_dir):
    c = TB.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("custkey"),
        F.concat(F.col("c_name"), F.lit(", "), F.col("c_mktsegment")).alias("label"),
        F.col("c_acctbal").alias("balance"))
    path = scratch_path(spark, "churn-csv")
    W.write_csv(c, path, header=True, sep=",", quote="|")   # labels contain the delimiter
    return R.read_quoted_csv(spark, path, _QUOTED_SCHEMA, sep=",", quote="|")


# Fixed lookup rows held in driver memory: weight of each event type.
EVENT_TYPE_WEIGHTS = [("view", 1), ("click", 2), ("signup", 5), ("purchase", 10), ("error", 0)]


@query("inline_rows", """
    WITH w(event_type, weight) AS (VALUES ('view', 1), ('click', 2), ('signup', 5), ('purchase', 10), ('error', 0))
    SELECT e.user_id, CAST(sum(w.weight) AS BIGINT) AS score FROM events e JOIN w ON e.event_type = w.event_type
    GROUP BY e.user_id""")
def inline_rows(spark, sf_dir):
    schema = T.StructType([T.StructField("event_type", T.StringType()), T.StructField("weight", T.IntegerType())])
    w = spark.createDataFrame(EVENT_TYPE_WEIGHTS, schema)
    e = TB.table(spark, sf_dir, "events")
    # five rows: broadcasting them is bounded by construction
    return e.join(F.broadcast(w), "event_type").groupBy("user_id").agg(F.sum("weight").cast("long").alias("score"))


@query("personal_ratings", TB.with_views(f"""
    SELECT "user", item, rating, {_EPOCH} AS ts FROM ratings WHERE "user" = 0 AND rating > 0""", "ratings"))
def personal_ratings(spark, sf_dir):
    from kestrel.plans.relational import PERSONAL_USER
    path = scratch_path(spark, "personal-ratings")
    mine = TB.ratings(spark, sf_dir).where(F.col("user") == PERSONAL_USER).withColumn("ts", F.unix_timestamp("ts"))
    W.write_delimited_text(mine, path, ["user", "item", "rating", "ts"], "::")
    return R.load_personal_ratings(spark, path)


@query("sink_parquet_roundtrip", TB.with_views("""
    SELECT v."number" AS vehicle_number, p.lat, p.lon, p.ts, p.speed
    FROM pings p JOIN vehicles v ON p.vehicle = v.id WHERE p.lat <> 0""", "pings", "vehicles"))
def sink_parquet_roundtrip(spark, sf_dir):
    fd = M.fleet_dimension(TB.vehicles(spark, sf_dir), TB.fleets(spark, sf_dir))
    clean = M.clean_pings(TB.pings(spark, sf_dir), fd).select("vehicle_number", "lat", "lon", "ts", "speed")
    path = scratch_path(spark, "channel-full")
    W.write_parquet(clean, path)            # materialise: cuts the lineage for later stages
    return spark.read.parquet(path)


@query("sink_csv_roundtrip", """
    SELECT c_nationkey AS nation, count(*) AS customers, round(sum(c_acctbal), 2) AS balance
    FROM customer GROUP BY c_nationkey""")
def sink_csv_roundtrip(spark, sf_dir):
    c = TB.table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("nation")).agg(
        F.count("*").alias("customers"), F.round(F.sum("c_acctbal"), 2).alias("balance"))
    path = scratch_path(spark, "report-csv")
    W.write_csv(c, path, header=True, single_file=True)  # one file: the result is one row per nation
    schema = T.StructType([T.StructField("nation", T.IntegerType()), T.StructField("customers", T.LongType()),
                           T.StructField("balance", T.DoubleType())])
    return R.read_header_csv(spark, path, schema)


@query("sink_index_roundtrip", TB.with_views("""
    SELECT nino, housing AS "housingCosts", 'Top Centile Housing Costs' AS risk_category, tstamp,
           CAST(date_part('month', tstamp) AS INTEGER) AS batch_id FROM customers""", "customers"))
def sink_index_roundtrip(spark, sf_dir):
    root = scratch_path(spark, "index")
    docs = TB.customers(spark, sf_dir).select(
        "nino", F.col("housing").alias("housingCosts"), F.lit("Top Centile Housing Costs").alias("risk_category"),
        "tstamp", F.month("tstamp").alias("batch_id"))
    # one batch per month; then month 1 is replayed: it replaces, not duplicates
    write_index_batches(docs, root, "risks/topCentileHousingCosts")
    write_index(docs.where(F.col("batch_id") == 1), root, "risks/topCentileHousingCosts", 1)
    return read_index(spark, root, "risks/topCentileHousingCosts")


@query("index_schema_cast", TB.with_views("""
    WITH n AS (SELECT """ + ", ".join(f"string_split(line, '@|')[{i + 1}] AS \"{f}\"" for i, f in enumerate(TB.CUSTOMER_FIELDS))
    + """ FROM customer_lines)
    SELECT address, CAST("childCareCosts" AS DOUBLE) AS "childCareCosts", CAST(dob AS DATE) AS dob, firstname,
           CAST("housingCosts" AS DOUBLE) AS "housingCosts", nino, postcode, surname,
           make_timestamp(CAST(tstamp AS BIGINT) * 1000000) AS tstamp FROM n""", "customer_lines"))
def index_schema_cast(spark, sf_dir):
    from kestrel.functions.parse import name_fields, split_literal, typed_customer
    l = TB.customer_lines(spark, sf_dir).withColumn("_p", split_literal("line", TB.CUSTOMER_DELIM))
    docs = typed_customer(name_fields(l, "_p", TB.CUSTOMER_FIELDS))
    root = scratch_path(spark, "index")
    write_index(docs, root, "customers/customer", 0)
    out = read_index(spark, root, "customers/customer").drop("batch_id")
    assert [f.name for f in out.schema.fields] == [f.name for f in INDEX_SCHEMAS["customers/customer"].fields]
    return out


@query("encode_delimited", TB.with_views("""
    SELECT CAST(vehicle AS VARCHAR) || ',' || strftime(ts, '%Y-%m-%dT%H:%M:%S') || ',' || printf('%.6f', lat) || ','
           || printf('%.6f', lon) AS "value" FROM pings""", "pings"))
def encode_delimited(spark, sf_dir):
    p = TB.pings(spark, sf_dir).select(
        F.col("vehicle"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("t"),
        F.format_string("%.6f", "lat").alias("lat"), F.format_string("%.6f", "lon").alias("lon"))
    return W.encode_delimited(p, ["vehicle", "t", "lat", "lon"], ",")


@query("encode_json_array", """
    SELECT CAST(to_json([CAST(c_custkey AS VARCHAR), c_name, c_mktsegment]) AS VARCHAR) AS "value" FROM customer""")
def encode_json_array(spark, sf_dir):
    c = TB.table(spark, sf_dir, "customer")
    return W.encode_json_array(c, ["c_custkey", "c_name", "c_mktsegment"])


_SPACE_SCHEMA = T.StructType([T.StructField("user", T.IntegerType()), T.StructField("artist", T.IntegerType()),
                              T.StructField("plays", T.LongType())])


@query("space_delimited_stats", TB.with_views("""
    WITH p AS (SELECT "user", item AS artist, count(*) AS plays FROM ratings GROUP BY "user", item)
    SELECT 'user' AS field, count("user") AS "count", round(avg("user"), 6) AS mean, round(stddev_pop("user"), 6) AS stdev,
           max("user") AS "max", min("user") AS "min" FROM p
    UNION ALL
    SELECT 'artist', count(artist), round(avg(artist), 6), round(stddev_pop(artist), 6), max(artist), min(artist) FROM p""",
    "ratings"))
def space_delimited_stats(spark, sf_dir):
    """Space-delimited ``user artist plays`` lines → stats of the first two fields."""
    from kestrel.operators.stats import numeric_stats
    plays = TB.ratings(spark, sf_dir).groupBy("user", F.col("item").alias("artist")).agg(F.count("*").alias("plays"))
    path = scratch_path(spark, "user-artist")
    W.write_delimited_text(plays, path, ["user", "artist", "plays"], " ")
    d = spark.read.schema(_SPACE_SCHEMA).option("sep", " ").csv(path)
    out = None
    for c in ("user", "artist"):
        s = numeric_stats(d, c).select(F.lit(c).alias("field"), "count", F.round("mean", 6).alias("mean"),
                                       F.round("stdev", 6).alias("stdev"), "max", "min")
        out = s if out is None else out.unionByName(s)
    return out
