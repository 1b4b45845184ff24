"""Driver tables and the fixture views derived from them.

Each view exists twice: as a DataFrame (what the jobs read) and as a SQL
snippet (what the DuckDB oracle reads).  Both derive the same columns from the
same source columns with the same arithmetic, so results compare exactly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table; parquet scan (filters and projections push down)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ---------------------------------------------------------------- ratings
def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``ratings(user int, item int, rating double, ts timestamp_ntz)`` from events."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("user_id").cast("int").alias("user"),
        (F.col("event_id") % 200).cast("int").alias("item"),
        (1 + (F.col("event_id") * 7 + F.col("user_id")) % 5).cast("double").alias("rating"),
        F.col("ts"),
    )


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``catalog(item int, title string)``: the whole part table."""
    p = table(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").cast("int").alias("item"), F.col("p_name").alias("title"))


# ---------------------------------------------------------------- telematics
def pings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``pings(vehicle, ts, lat, lon, speed)``: one position report per event."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("user_id").alias("vehicle"),
        F.col("ts"),
        (F.lit(51.0) + (F.col("event_id") % 997).cast("double") / 997.0).alias("lat"),
        (F.lit(-1.0) + (F.col("event_id") % 991).cast("double") / 991.0).alias("lon"),
        F.col("value").alias("speed"),
    )


def vehicles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``vehicles(id bigint, number int, class int)`` from customer."""
    c = table(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").alias("id"), F.col("c_custkey").cast("int").alias("number"),
                    F.col("c_nationkey").alias("class"))


def fleets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``fleets(class int, fleet_id int)`` from nation."""
    n = table(spark, sf_dir, "nation")
    return n.select(F.col("n_nationkey").alias("class"), F.col("n_regionkey").alias("fleet_id"))


# ---------------------------------------------------------------- customers stream
def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``customers(tstamp, nino, housing, childcare, event_id)`` from events."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("ts").alias("tstamp"),
        F.col("user_id").cast("string").alias("nino"),
        F.col("value").alias("housing"),
        (F.col("value") * 0.8 + (F.col("event_id") % 50).cast("double")).alias("childcare"),
        F.col("event_id"),
    )


# ---------------------------------------------------------------- text
def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lines(src, id, text)``: every document and every conversation turn."""
    d = table(spark, sf_dir, "documents").select(
        F.lit("doc").alias("src"), F.col("doc_id").alias("id"), F.col("text"))
    c = table(spark, sf_dir, "conversations").select(
        F.lit("conv").alias("src"), (F.col("conv_id") * 1000 + F.col("turn")).alias("id"), F.col("text"))
    return d.unionByName(c)


# ---------------------------------------------------------------- SQL side
VIEW_SQL = {
    "ratings": """SELECT CAST(user_id AS INTEGER) AS "user", CAST(event_id % 200 AS INTEGER) AS item,
        CAST(1 + (event_id * 7 + user_id) % 5 AS DOUBLE) AS rating, ts FROM events""",
    "catalog": """SELECT CAST(p_partkey AS INTEGER) AS item, p_name AS title FROM part""",
    "pings": """SELECT user_id AS vehicle, ts,
        51.0 + CAST(event_id % 997 AS DOUBLE) / 997.0 AS lat,
        -1.0 + CAST(event_id % 991 AS DOUBLE) / 991.0 AS lon, "value" AS speed FROM events""",
    "vehicles": """SELECT c_custkey AS id, CAST(c_custkey AS INTEGER) AS "number", c_nationkey AS class FROM customer""",
    "fleets": """SELECT n_nationkey AS class, n_regionkey AS fleet_id FROM nation""",
    "customers": """SELECT ts AS tstamp, CAST(user_id AS VARCHAR) AS nino, "value" AS housing,
        "value" * 0.8 + CAST(event_id % 50 AS DOUBLE) AS childcare, event_id FROM events""",
    "lines": """SELECT 'doc' AS src, doc_id AS id, text FROM documents
        UNION ALL SELECT 'conv' AS src, conv_id * 1000 + turn AS id, text FROM conversations""",
}


def with_views(sql: str, *names: str) -> str:
    """Prefix ``sql`` with CTEs for the named fixture views (and merge its own WITH)."""
    ctes = ",\n".join(f"{n} AS ({VIEW_SQL[n]})" for n in names)
    body = sql.strip()
    if not names:
        return body
    if body[:4].upper() == "WITH":
        return f"WITH {ctes},\n{body[4:].lstrip()}"
    return f"WITH {ctes}\n{body}"


# ---------------------------------------------------------------- delimited customer messages
# Field order of a customer message (``@|``-delimited), fixed by the original feed.
CUSTOMER_FIELDS = ["tstamp", "firstname", "surname", "dob", "nino", "housingCosts",
                   "childCareCosts", "address", "postcode"]
CUSTOMER_DELIM = "@|"


def customer_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``customer_lines(event_id, line)``: one ``@|``-delimited message per event."""
    e = table(spark, sf_dir, "events")
    c = table(spark, sf_dir, "customer")
    j = e.join(c, e["user_id"] == c["c_custkey"])
    dob = F.date_format(F.date_add(F.lit("1950-01-01").cast("date"), (F.col("c_custkey") % 18000).cast("int")),
                        "yyyy-MM-dd")
    fields = [
        F.unix_timestamp("ts").cast("string"), F.col("c_mktsegment"), F.col("c_name"), dob,
        F.col("user_id").cast("string"), F.format_string("%.2f", F.col("value")),
        F.format_string("%.3f", F.col("value") * 0.8 + (F.col("event_id") % 50).cast("double")),
        F.concat(F.lit("Nation "), F.col("c_nationkey").cast("string")),
        F.concat(F.lit("PC"), F.col("c_custkey").cast("string")),
    ]
    whole = [F.coalesce(f, F.lit("")) for f in fields]             # a NULL is an empty field
    return j.select("event_id", F.concat_ws(CUSTOMER_DELIM, *whole).alias("line"))


VIEW_SQL["customer_lines"] = """SELECT e.event_id, concat_ws('@|',
    CAST(epoch_us(e.ts) // 1000000 AS VARCHAR), c.c_mktsegment, c.c_name,
    strftime(DATE '1950-01-01' + CAST(c.c_custkey % 18000 AS INTEGER), '%Y-%m-%d'),
    CAST(e.user_id AS VARCHAR), printf('%.2f', e."value"),
    printf('%.3f', e."value" * 0.8 + CAST(e.event_id % 50 AS DOUBLE)),
    'Nation ' || CAST(c.c_nationkey AS VARCHAR), 'PC' || CAST(c.c_custkey AS VARCHAR)) AS line
    FROM events e JOIN customer c ON e.user_id = c.c_custkey"""


# ---------------------------------------------------------------- timed text and rating messages
def timed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``timed_lines(src, id, ts, text)``: every document / conversation turn with an arrival time."""
    base = F.lit("2024-01-01").cast("timestamp_ntz")
    d = table(spark, sf_dir, "documents").select(
        F.lit("doc").alias("src"), F.col("doc_id").alias("id"),
        (base + F.make_dt_interval(mins=(F.col("doc_id") * 7).cast("int"))).alias("ts"), "text")
    c = table(spark, sf_dir, "conversations").select(
        F.lit("conv").alias("src"), (F.col("conv_id") * 1000 + F.col("turn")).alias("id"),
        (base + F.make_dt_interval(mins=(F.col("conv_id") * 11).cast("int"), secs=F.col("turn").cast("int")))
        .alias("ts"), "text")
    return d.unionByName(c)


def rating_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``rating_messages(ts, value)``: ``tstamp,user,item,rating`` lines of the rating feed."""
    r = ratings(spark, sf_dir)
    fields = [F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.col("user").cast("string"), F.col("item").cast("string"),
              F.col("rating").cast("string")]
    return r.select("ts", F.concat_ws(",", *[F.coalesce(f, F.lit("")) for f in fields]).alias("value"))


VIEW_SQL["timed_lines"] = """SELECT 'doc' AS src, doc_id AS id, TIMESTAMP '2024-01-01' + to_minutes(CAST(doc_id * 7 AS BIGINT)) AS ts, text
    FROM documents UNION ALL
    SELECT 'conv' AS src, conv_id * 1000 + turn AS id,
           TIMESTAMP '2024-01-01' + to_minutes(CAST(conv_id * 11 AS BIGINT)) + to_seconds(CAST(turn AS BIGINT)) AS ts, text
    FROM conversations"""


# ---------------------------------------------------------------- churn features
CHURN_NUMERIC = ["account_length", "number_vmail_messages", "total_day_minutes", "total_day_calls",
                 "total_day_charge", "total_eve_minutes", "total_eve_calls", "total_eve_charge",
                 "total_night_minutes", "total_night_calls", "total_intl_minutes", "total_intl_calls",
                 "total_intl_charge"]


def churn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer: 13 numeric usage columns from its orders, plan flags, a planted label."""
    c = table(spark, sf_dir, "customer")
    o = table(spark, sf_dir, "orders")
    p = F.col("o_totalprice")
    agg = o.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count("*").cast("double").alias("number_vmail_messages"),
        (F.sum(p) / 1000.0).alias("total_day_minutes"),
        F.count(F.when(F.col("o_orderstatus") == "F", 1)).cast("double").alias("total_day_calls"),
        F.avg(p).alias("total_day_charge"),
        F.max(p).alias("total_eve_minutes"),
        F.count(F.when(F.col("o_orderstatus") == "O", 1)).cast("double").alias("total_eve_calls"),
        F.min(p).alias("total_eve_charge"),
        F.coalesce(F.sum(F.when(F.col("o_orderpriority") == "1-URGENT", p)), F.lit(0.0)).alias("total_night_minutes"),
        F.count(F.when(F.col("o_orderpriority") == "1-URGENT", 1)).cast("double").alias("total_night_calls"),
        F.coalesce(F.sum(F.when(F.col("o_orderstatus") == "P", p)), F.lit(0.0)).alias("total_intl_minutes"),
        F.count(F.when(F.col("o_orderstatus") == "P", 1)).cast("double").alias("total_intl_calls"),
        F.countDistinct("o_orderpriority").cast("double").alias("total_intl_charge"),
        F.count(F.when(F.col("o_orderpriority") == "5-LOW", 1)).cast("double").alias("number_customer_service_calls"))
    j = c.join(agg, "c_custkey")
    return j.select(
        F.col("c_custkey").alias("customer"), F.col("c_mktsegment").alias("state"),
        F.col("c_acctbal").alias("account_length"), *CHURN_NUMERIC[1:], "number_customer_service_calls",
        F.when(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"), "yes").otherwise("no").alias("intl_plan"),
        F.when((F.col("c_acctbal") < 1000) | (F.col("number_vmail_messages") < 8), "True").otherwise("False")
        .alias("churned"))


VIEW_SQL["churn"] = """SELECT c.c_custkey AS customer, c.c_mktsegment AS state, c.c_acctbal AS account_length,
    CAST(count(*) AS DOUBLE) AS number_vmail_messages, sum(o.o_totalprice) / 1000.0 AS total_day_minutes,
    CAST(count(*) FILTER (WHERE o.o_orderstatus = 'F') AS DOUBLE) AS total_day_calls,
    avg(o.o_totalprice) AS total_day_charge, max(o.o_totalprice) AS total_eve_minutes,
    CAST(count(*) FILTER (WHERE o.o_orderstatus = 'O') AS DOUBLE) AS total_eve_calls,
    min(o.o_totalprice) AS total_eve_charge,
    coalesce(sum(o.o_totalprice) FILTER (WHERE o.o_orderpriority = '1-URGENT'), 0.0) AS total_night_minutes,
    CAST(count(*) FILTER (WHERE o.o_orderpriority = '1-URGENT') AS DOUBLE) AS total_night_calls,
    coalesce(sum(o.o_totalprice) FILTER (WHERE o.o_orderstatus = 'P'), 0.0) AS total_intl_minutes,
    CAST(count(*) FILTER (WHERE o.o_orderstatus = 'P') AS DOUBLE) AS total_intl_calls,
    CAST(count(DISTINCT o.o_orderpriority) AS DOUBLE) AS total_intl_charge,
    CAST(count(*) FILTER (WHERE o.o_orderpriority = '5-LOW') AS DOUBLE) AS number_customer_service_calls,
    CASE WHEN c.c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'yes' ELSE 'no' END AS intl_plan,
    CASE WHEN c.c_acctbal < 1000 OR count(*) < 8 THEN 'True' ELSE 'False' END AS churned
    FROM customer c JOIN orders o ON o.o_custkey = c.c_custkey
    GROUP BY c.c_custkey, c.c_mktsegment, c.c_acctbal"""
