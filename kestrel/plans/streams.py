"""Streaming queries.  Each one stages its input from the driver tables as
time-ordered files, runs the Structured Streaming job to completion
(``availableNow``, checkpointed) and returns what the sink holds.  The SQL
oracle is the batch meaning of the same job, so a match means streaming = batch."""

from __future__ import annotations

from pyspark.sql import functions as F

from kestrel.functions.parse import name_fields, split_literal, typed_customer
from kestrel.operators import stats as S
from kestrel.operators.topk import top_k_per_group
from kestrel.plans.registry import query
from kestrel.session import scratch_path
from kestrel.sinks.index import read_index, write_index
from kestrel.sources import tables as TB
from kestrel.streaming import jobs as J
from kestrel.streaming import runner as RN

N_FILES = 5


def _rating_feed(spark, sf_dir):
    """(rating messages replayed as text lines and parsed, the feed's lateness)."""
    src = scratch_path(spark, "rating-feed")
    staged = RN.stage_files(TB.rating_messages(spark, sf_dir), src, "ts", N_FILES, fmt="text", text_col="value")
    return J.parse_rating_messages(RN.stream_source(spark, "files", path=f"{src}/*", max_files=staged.files)), staged


def _rating_stream(spark, sf_dir):
    return _rating_feed(spark, sf_dir)[0]


def _model(spark, sf_dir):
    """Item-mean model trained on the training split (static side of the joins)."""
    sp = S.split_by_digit(TB.ratings(spark, sf_dir))
    return RN.materialize(spark, S.item_mean_predictor(sp.where(F.col("split") == "train")), "item-mean-model")


def _staged(spark, df, order, name):
    """(stream over the staged files, what staging tells about their order)."""
    src = scratch_path(spark, name)
    staged = RN.stage_files(df, src, order, N_FILES)
    return RN.file_stream(spark, src, df.schema, max_files=staged.files), staged


_MODEL_SQL = """sp AS (SELECT *, CASE WHEN (epoch_us(ts) // 1000000) % 10 < 6 THEN 'train'
         WHEN (epoch_us(ts) // 1000000) % 10 < 8 THEN 'validation' ELSE 'test' END AS split FROM ratings),
    im AS (SELECT item, avg(rating) AS prediction FROM sp WHERE split = 'train' GROUP BY item),
    sc AS (SELECT r.ts AS tstamp, r."user", r.item, r.rating, round(im.prediction, 1) AS prediction
           FROM ratings r JOIN im ON r.item = im.item)"""


@query("stream_ingest_lines", TB.with_views("""
    SELECT ts AS tstamp, "user", item, rating FROM ratings""", "ratings"))
def stream_ingest_lines(spark, sf_dir):
    return RN.run_append(spark, _rating_stream(spark, sf_dir), "ingest")


@query("stream_static_join", TB.with_views("""
    SELECT r.ts AS tstamp, r."user", r.item, r.rating, c.title FROM ratings r JOIN catalog c ON r.item = c.item""",
    "ratings", "catalog"))
def stream_static_join(spark, sf_dir):
    joined = _rating_stream(spark, sf_dir).join(TB.catalog(spark, sf_dir), "item")
    return RN.run_append(spark, joined.select("tstamp", "user", "item", "rating", "title"), "static-join")


@query("rating_error_docs", TB.with_views("WITH " + _MODEL_SQL + """
    SELECT sc.tstamp, sc."user" AS "userID", sc.item AS "movieID", c.title AS "movieTitle",
           sc.prediction AS "predictedRating", sc.rating AS "actualRating",
           round(abs(sc.prediction - sc.rating), 6) AS "absError", round(sc.prediction - sc.rating, 6) AS "absoluteError",
           round(pow(sc.prediction - sc.rating, 2), 6) AS "squareError"
    FROM sc JOIN catalog c ON sc.item = c.item""", "ratings", "catalog"))
def rating_error_docs(spark, sf_dir):
    docs = J.error_docs(J.score(_rating_stream(spark, sf_dir), _model(spark, sf_dir)), TB.catalog(spark, sf_dir))
    out = RN.run_append(spark, docs, "error-docs")
    return out.select("tstamp", "userID", "movieID", "movieTitle", "predictedRating", "actualRating",
                      *[F.round(c, 6).alias(c) for c in ("absError", "absoluteError", "squareError")])


_WIN_ERR = """we AS (SELECT time_bucket(INTERVAL 1 DAY, tstamp) AS window_start, count(*) AS n,
       avg(pow(prediction - rating, 2)) AS mse, sqrt(avg(pow(prediction - rating, 2))) AS rmse,
       stddev_pop(rating) AS baseline_rmse FROM sc GROUP BY 1)"""


def _window_error(spark, sf_dir, name):
    feed, staged = _rating_feed(spark, sf_dir)
    scored = J.score(feed, _model(spark, sf_dir))
    return RN.run_update_aggregate(spark, J.windowed_error(scored, "1 day", staged.lateness()), ["window_start"], name)


@query("batch_rmse", TB.with_views("WITH " + _MODEL_SQL + ", " + _WIN_ERR + """
    SELECT window_start, n, round(mse, 6) AS mse, round(rmse, 6) AS rmse FROM we""", "ratings"))
def batch_rmse(spark, sf_dir):
    e = _window_error(spark, sf_dir, "batch-rmse")
    return e.select("window_start", "n", F.round("mse", 6).alias("mse"), F.round("rmse", 6).alias("rmse"))


@query("batch_rmse_baseline", TB.with_views("WITH " + _MODEL_SQL + ", " + _WIN_ERR + """
    SELECT window_start, n, round(baseline_rmse, 6) AS baseline_rmse FROM we""", "ratings"))
def batch_rmse_baseline(spark, sf_dir):
    e = _window_error(spark, sf_dir, "batch-rmse-base")
    return e.select("window_start", "n", F.round("baseline_rmse", 6).alias("baseline_rmse"))


@query("stream_running_rmse", TB.with_views("WITH " + _MODEL_SQL + """
    SELECT count(*) AS n, round(sqrt(sum(pow(prediction - rating, 2)) / count(*)), 6) AS rmse FROM sc""", "ratings"))
def stream_running_rmse(spark, sf_dir):
    scored = J.score(_rating_stream(spark, sf_dir), _model(spark, sf_dir))
    r = RN.run_update_aggregate(spark, J.running_rmse(scored), ["scope"], "running-rmse")
    return r.select("n", F.round("rmse", 6).alias("rmse"))


@query("same_batch_join", TB.with_views("""
    WITH g AS (SELECT "user", item, avg(rating) AS avg_rating, count(*) AS n FROM ratings GROUP BY "user", item),
    top AS (SELECT "user", item, row_number() OVER (PARTITION BY "user" ORDER BY avg_rating DESC, n DESC, item) AS "rank"
            FROM g QUALIFY "rank" <= 5)
    SELECT r.ts AS tstamp, r."user", t."rank", t.item FROM ratings r JOIN top t ON r."user" = t."user\"""", "ratings"))
def same_batch_join(spark, sf_dir):
    g = TB.ratings(spark, sf_dir).groupBy("user", "item").agg(F.avg("rating").alias("avg_rating"), F.count("*").alias("n"))
    top = top_k_per_group(g, ["user"], [F.desc("avg_rating"), F.desc("n"), F.col("item")], 5)
    top = RN.materialize(spark, top.select("user", F.col("rank").cast("long").alias("rank"), "item"), "user-top5")
    out = scratch_path(spark, "recs-out")

    def per_batch(batch, batch_id):
        if batch.isEmpty():
            return
        # the batch's ratings joined with the recommendations of the same users
        j = batch.select("tstamp", "user").join(top, "user").select("tstamp", "user", "rank", "item")
        j.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    RN.run_available_now(_rating_stream(spark, sf_dir), per_batch, scratch_path(spark, "recs-ckpt"))
    return spark.read.parquet(out).drop("batch_id")


@query("stream_tumbling_count", TB.with_views("""
    SELECT time_bucket(INTERVAL 1 HOUR, tstamp) AS window_start, count(*) AS "count" FROM customers GROUP BY 1""",
    "customers"))
def stream_tumbling_count(spark, sf_dir):
    s, staged = _staged(spark, TB.customers(spark, sf_dir), "tstamp", "customers-feed")
    return RN.run_update_aggregate(spark, J.tumbling_count(s, "tstamp", "1 hour", staged.lateness()), ["window_start"],
                                   "tumbling")


@query("stream_sliding_count", TB.with_views("""
    WITH x AS (SELECT time_bucket(INTERVAL 1 HOUR, tstamp) - to_hours(CAST(unnest(range(10)) AS BIGINT)) AS window_start
               FROM customers)
    SELECT window_start, window_start + INTERVAL 10 HOUR AS window_end, count(*) AS "count" FROM x GROUP BY 1""",
    "customers"))
def stream_sliding_count(spark, sf_dir):
    s, staged = _staged(spark, TB.customers(spark, sf_dir), "tstamp", "customers-feed")
    agg = J.sliding_count(s, "tstamp", "10 hours", "1 hour", staged.lateness())
    return RN.run_update_aggregate(spark, agg, ["window_start", "window_end"], "sliding")


@query("stream_window_wordcount", TB.with_views("""
    SELECT time_bucket(INTERVAL 1 DAY, ts) AS window_start, word, count(*) AS "count"
    FROM (SELECT ts, unnest(string_split(text, ' ')) AS word FROM timed_lines) x GROUP BY 1, 2""", "timed_lines"))
def stream_window_wordcount(spark, sf_dir):
    s, staged = _staged(spark, TB.timed_lines(spark, sf_dir), "ts", "lines-feed")
    # the open windows hold about as many keys as two chunks have different words a day
    return RN.run_update_aggregate(spark, J.tumbling_word_count(s, "1 day", staged.lateness()), ["window_start", "word"],
                                   "window-wc", disk_state=True)


@query("stream_running_wordcount", TB.with_views("""
    SELECT word, count(*) AS "count" FROM (SELECT unnest(string_split(text, ',')) AS word FROM timed_lines) x
    GROUP BY word""", "timed_lines"))
def stream_running_wordcount(spark, sf_dir):
    s, staged = _staged(spark, TB.timed_lines(spark, sf_dir), "ts", "lines-feed")
    return RN.run_update_aggregate(spark, J.running_word_count(s, ","), ["word"], "running-wc")


@query("stream_restart_wordcount", TB.with_views("""
    SELECT word, count(*) AS "count" FROM (SELECT unnest(string_split(text, ',')) AS word FROM timed_lines) x
    GROUP BY word""", "timed_lines"))
def stream_restart_wordcount(spark, sf_dir):
    """Two runs over a growing input with one checkpoint = one run over all of it."""
    lines = TB.timed_lines(spark, sf_dir)
    staged = scratch_path(spark, "restart-staged")
    chunks = RN.stage_files(lines, staged, "ts", N_FILES).paths
    src, out, ckpt = scratch_path(spark, "restart-src"), scratch_path(spark, "restart-out"), scratch_path(spark, "restart-ckpt")

    def run():
        parts = [f"{src}/part={i:05d}" for i in range(len(chunks))]
        s = RN.file_stream(spark, src, lines.schema, max_files=RN.most_files(spark, parts))
        RN.run_available_now(J.running_word_count(s, ","), RN.batch_partition_writer(out), ckpt, mode="update")

    for i, c in enumerate(chunks):          # the input grows; the query restarts from its checkpoint
        spark.read.parquet(c).write.mode("overwrite").parquet(f"{src}/part={i:05d}")
        if i in (2, len(chunks) - 1):
            run()
    return RN.read_changelog(spark, out, ["word"])


@query("stream_foreach_batch", TB.with_views("""
    WITH n AS (SELECT """ + ", ".join(f"string_split(line, '@|')[{i + 1}] AS \"{f}\"" for i, f in enumerate(TB.CUSTOMER_FIELDS))
    + """ FROM customer_lines)
    SELECT address, CAST("childCareCosts" AS DOUBLE) AS "childCareCosts", CAST(dob AS DATE) AS dob, firstname,
           CAST("housingCosts" AS DOUBLE) AS "housingCosts", nino, postcode, surname,
           make_timestamp(CAST(tstamp AS BIGINT) * 1000000) AS tstamp FROM n""", "customer_lines"))
def stream_foreach_batch(spark, sf_dir):
    lines = TB.customer_lines(spark, sf_dir).withColumn(
        "ts", F.timestamp_seconds(F.try_element_at(split_literal("line", "@|"), F.lit(1)).cast("long")))
    src = scratch_path(spark, "customer-feed")
    staged = RN.stage_files(lines, src, "ts", N_FILES, fmt="text", text_col="line")
    root = scratch_path(spark, "customer-index")

    def per_batch(batch, batch_id):
        if batch.isEmpty():                   # emptiness guard
            return
        recs = typed_customer(name_fields(batch.withColumn("_p", split_literal("value", "@|")), "_p",
                                          TB.CUSTOMER_FIELDS))
        write_index(recs, root, "customers/customer", batch_id)

    stream = RN.stream_source(spark, "files", path=f"{src}/*", max_files=staged.files)
    RN.run_available_now(stream, per_batch, scratch_path(spark, "cust-ckpt"))
    return read_index(spark, root, "customers/customer").drop("batch_id")


@query("wordcount_batch", TB.with_views("""
    SELECT word, count(*) AS "count" FROM (SELECT unnest(string_split(text, ' ')) AS word FROM lines) x
    GROUP BY word""", "lines"))
def wordcount_batch(spark, sf_dir):
    return J.words(TB.lines(spark, sf_dir), " ").groupBy("word").count()


@query("wordcount_blocklist", TB.with_views("""
    WITH w AS (SELECT word, count(*) AS "count" FROM (SELECT unnest(string_split(text, ' ')) AS word FROM lines) x
               GROUP BY word)
    SELECT word, "count", (SELECT CAST(sum("count") AS BIGINT) FROM w WHERE word IN ('a', 'b', 'c')) AS dropped_total
    FROM w WHERE word NOT IN ('a', 'b', 'c')""", "lines"))
def wordcount_blocklist(spark, sf_dir):
    # the flag is an aggregate, so no filter moves below it and both readers share one scan and shuffle
    counts = J.words(TB.lines(spark, sf_dir), " ").groupBy("word").agg(
        F.count("*").alias("count"), F.max(F.col("word").isin(J.BLOCKLIST)).alias("blocked"))
    dropped = counts.where("blocked").select(F.sum("count")).scalar()   # the accumulator, as an aggregate
    return counts.where("NOT blocked").select("word", "count", dropped.alias("dropped_total"))


@query("wordcount_batch_log", TB.with_views("""
    SELECT word, CAST(count(*) AS BIGINT) AS total FROM (SELECT unnest(string_split(text, ' ')) AS word FROM timed_lines) x
    WHERE word NOT IN ('a', 'b', 'c') GROUP BY word""", "timed_lines"))
def wordcount_batch_log(spark, sf_dir):
    s, staged = _staged(spark, TB.timed_lines(spark, sf_dir), "ts", "log-feed")
    log = scratch_path(spark, "wc-log")

    def echo(batch, batch_id):
        counts = J.words(batch, " ").groupBy("word").count().where(~F.col("word").isin(J.BLOCKLIST))
        (counts.withColumn("batch_time", F.current_timestamp())
         .write.mode("overwrite").parquet(f"{log}/batch_id={batch_id}"))   # "Counts at time t [...]"

    RN.run_available_now(s, echo, scratch_path(spark, "wc-log-ckpt"))
    return spark.read.parquet(log).groupBy("word").agg(F.sum("count").cast("long").alias("total"))


# ---------------------------------------------------------------- risk flags
# Slot width and window length in slots.  The original ran 1-second batches and
# a 10-batch window; the test data is sparse (days), so slots are 6 hours.
RISK_SLIDE_SECONDS = 6 * 3600
RISK_WINDOW_SLOTS = 10

_RISK_SQL = f"""c AS (SELECT tstamp, nino, 'Top Centile Housing Costs' AS risk_category, housing AS cost FROM customers
        UNION ALL SELECT tstamp, nino, 'Top Centile Childcare Costs', childcare FROM customers),
    cs AS (SELECT *, (epoch_us(tstamp) // 1000000) // {RISK_SLIDE_SECONDS} AS slot FROM c),
    ex AS (SELECT risk_category, cost, slot + unnest(range({RISK_WINDOW_SLOTS})) AS end_slot FROM cs),
    r AS (SELECT risk_category, end_slot, cost,
                 row_number() OVER (PARTITION BY risk_category, end_slot ORDER BY cost DESC) AS rn,
                 count(*) OVER (PARTITION BY risk_category, end_slot) AS n FROM ex),
    thr AS (SELECT risk_category, end_slot, n, n // 10 AS k, max(CASE WHEN rn = n // 10 THEN cost END) AS kth
            FROM r GROUP BY 1, 2, 3),
    cut AS (SELECT risk_category, end_slot, last_value(kth IGNORE NULLS) OVER (PARTITION BY risk_category
            ORDER BY end_slot ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS cutoff FROM thr)"""


@query("sliding_topdecile", TB.with_views("WITH " + _RISK_SQL + """
    SELECT risk_category, CAST(end_slot AS BIGINT) AS end_slot, n, k, kth FROM thr""", "customers"))
def sliding_topdecile(spark, sf_dir):
    from kestrel.operators.risk import long_costs, window_thresholds
    t = window_thresholds(long_costs(TB.customers(spark, sf_dir)), RISK_SLIDE_SECONDS, RISK_WINDOW_SLOTS)
    return t.select("risk_category", "end_slot", "n", "k", "kth")


@query("risk_flags", TB.with_views("WITH " + _RISK_SQL + """
    SELECT cs.tstamp, cs.nino, cs.risk_category, cs.cost FROM cs
    JOIN cut ON cs.risk_category = cut.risk_category AND cs.slot = cut.end_slot WHERE cs.cost > cut.cutoff""",
    "customers"))
def risk_flags(spark, sf_dir):
    from kestrel.streaming.risk import run_risk_flags
    stream, staged = _staged(spark, TB.customers(spark, sf_dir), "tstamp", "risk-feed")
    return run_risk_flags(spark, stream, scratch_path(spark, "risk-state"), scratch_path(spark, "risk-ckpt"),
                          RISK_SLIDE_SECONDS, RISK_WINDOW_SLOTS,
                          lateness_slots=staged.span // RISK_SLIDE_SECONDS + 1)


@query("risk_flags_batch", TB.with_views("WITH " + _RISK_SQL + """
    SELECT cs.tstamp, cs.nino, cs.risk_category, cs.cost FROM cs
    JOIN cut ON cs.risk_category = cut.risk_category AND cs.slot = cut.end_slot WHERE cs.cost > cut.cutoff""",
    "customers"))
def risk_flags_batch(spark, sf_dir):
    from kestrel.operators.risk import risk_flags as flags
    return flags(TB.customers(spark, sf_dir), RISK_SLIDE_SECONDS, RISK_WINDOW_SLOTS)
