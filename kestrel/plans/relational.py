"""Relational base: splits, summaries, error metrics, joins, top-k, replay schedule."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from kestrel.operators import stats as S
from kestrel.operators.topk import kth_largest, top_k_per_group
from kestrel.plans.registry import query
from kestrel.sources import tables as T

# The "personal" user of the recommender jobs (the one whose own ratings file is loaded).
PERSONAL_USER = 0

_SPLIT = """sp AS (SELECT *, CAST((epoch_us(ts) // 1000000) % 10 AS INTEGER) AS digit,
    CASE WHEN (epoch_us(ts) // 1000000) % 10 < 6 THEN 'train'
         WHEN (epoch_us(ts) // 1000000) % 10 < 8 THEN 'validation' ELSE 'test' END AS split FROM ratings)"""
_MODEL = """im AS (SELECT item, avg(rating) AS prediction FROM sp WHERE split = 'train' GROUP BY item)"""


def _split(spark, sf_dir):
    return S.split_by_digit(T.ratings(spark, sf_dir))


def _personal(spark, sf_dir):
    r = T.ratings(spark, sf_dir)
    return r.where((F.col("user") == PERSONAL_USER) & (F.col("rating") > 0))


@query("split_by_digit", T.with_views("WITH " + _SPLIT + """
    SELECT "user", item, rating, digit, split FROM sp""", "ratings"))
def split_by_digit(spark, sf_dir):
    return _split(spark, sf_dir).select("user", "item", "rating", "digit", "split")


@query("dataset_summary", T.with_views("WITH " + _SPLIT + """
    SELECT count(*) AS n_ratings, count(DISTINCT "user") AS n_users, count(DISTINCT item) AS n_items,
           count(*) FILTER (WHERE split = 'train') AS n_train,
           count(*) FILTER (WHERE split = 'validation') AS n_validation,
           count(*) FILTER (WHERE split = 'test') AS n_test FROM sp""", "ratings"))
def dataset_summary(spark, sf_dir):
    return S.dataset_summary(_split(spark, sf_dir))


@query("value_counts", T.with_views("""
    SELECT item, count(*) AS "count" FROM ratings GROUP BY item""", "ratings"))
def value_counts(spark, sf_dir):
    return T.ratings(spark, sf_dir).groupBy("item").count()


@query("numeric_stats", T.with_views("""
    SELECT count(item) AS "count", round(avg(item), 6) AS mean, round(stddev_pop(item), 6) AS stdev,
           max(item) AS "max", min(item) AS "min" FROM ratings""", "ratings"))
def numeric_stats(spark, sf_dir):
    s = S.numeric_stats(T.ratings(spark, sf_dir), "item")
    return s.select("count", F.round("mean", 6).alias("mean"), F.round("stdev", 6).alias("stdev"), "max", "min")


@query("union_all", T.with_views("WITH " + _SPLIT + f"""
    SELECT "user", item, rating, 'train' AS src FROM sp WHERE split = 'train'
    UNION ALL SELECT "user", item, rating, 'personal' AS src FROM ratings
    WHERE "user" = {PERSONAL_USER} AND rating > 0""", "ratings"))
def union_all(spark, sf_dir):
    tr = _split(spark, sf_dir).where(F.col("split") == "train").select("user", "item", "rating", F.lit("train").alias("src"))
    me = _personal(spark, sf_dir).select("user", "item", "rating", F.lit("personal").alias("src"))
    return tr.unionByName(me)


@query("join_pred_actual", T.with_views("WITH " + _SPLIT + ", " + _MODEL + """,
    pr AS (SELECT p."user", p.item, im.prediction FROM (SELECT DISTINCT "user", item FROM sp WHERE split = 'test') p
           JOIN im ON p.item = im.item)
    SELECT pr."user", pr.item, round(pr.prediction, 6) AS prediction, t.rating, t.ts
    FROM pr JOIN sp t ON pr."user" = t."user" AND pr.item = t.item WHERE t.split = 'test'""", "ratings"))
def join_pred_actual(spark, sf_dir):
    sp = _split(spark, sf_dir)
    test = sp.where(F.col("split") == "test")
    preds = S.predict_pairs(S.item_mean_predictor(sp.where(F.col("split") == "train")), test)
    j = S.join_pred_actual(preds, test)
    return j.select("user", "item", F.round("prediction", 6).alias("prediction"), "rating", "ts")


@query("rmse", T.with_views("WITH " + _SPLIT + ", " + _MODEL + """,
    t AS (SELECT * FROM sp WHERE split = 'test')
    SELECT round(sqrt(sum(pow(im.prediction - t.rating, 2)) / count(*)), 6) AS rmse,
           count(im.prediction) AS n_joined, count(*) AS n_input
    FROM t LEFT JOIN im ON t.item = im.item""", "ratings"))
def rmse(spark, sf_dir):
    sp = _split(spark, sf_dir)
    test = sp.where(F.col("split") == "test")
    preds = S.predict_pairs(S.item_mean_predictor(sp.where(F.col("split") == "train")), test)
    r = S.rmse(preds, test)
    return r.select(F.round("rmse", 6).alias("rmse"), "n_joined", "n_input")


@query("baseline_rmse", T.with_views("WITH " + _SPLIT + ", " + _MODEL + """,
    mr AS (SELECT avg(rating) AS m FROM sp WHERE split IN ('train', 'validation')),
    t AS (SELECT * FROM sp WHERE split = 'test'),
    agg AS (SELECT sqrt(sum(pow(im.prediction - t.rating, 2)) / count(*)) AS model_rmse,
                   sqrt(sum(pow((SELECT m FROM mr) - t.rating, 2)) / count(*)) AS baseline_rmse
            FROM t LEFT JOIN im ON t.item = im.item)
    SELECT round((SELECT m FROM mr), 6) AS mean_rating, round(baseline_rmse, 6) AS baseline_rmse,
           round(model_rmse, 6) AS model_rmse,
           round((baseline_rmse - model_rmse) / baseline_rmse * 100, 4) AS improvement_pct FROM agg""", "ratings"))
def baseline_rmse(spark, sf_dir):
    sp = _split(spark, sf_dir)
    train = sp.where(F.col("split") == "train")
    test = sp.where(F.col("split") == "test")
    # mean over train ∪ validation, evaluated once as a scalar subquery
    mean = sp.where(F.col("split").isin("train", "validation")).select(F.avg("rating")).scalar()
    j = test.join(S.item_mean_predictor(train), "item", "left")
    agg = j.agg(F.sqrt(F.sum(F.pow(F.col("prediction") - F.col("rating"), 2)) / F.count("*")).alias("model_rmse"),
                F.sqrt(F.sum(F.pow(mean - F.col("rating"), 2)) / F.count("*")).alias("baseline_rmse"),
                F.first(mean).alias("mean_rating"))
    return agg.select(F.round("mean_rating", 6).alias("mean_rating"), F.round("baseline_rmse", 6).alias("baseline_rmse"),
                      F.round("model_rmse", 6).alias("model_rmse"),
                      F.round((F.col("baseline_rmse") - F.col("model_rmse")) / F.col("baseline_rmse") * 100, 4)
                      .alias("improvement_pct"))


@query("personal_ratings_filter", T.with_views(f"""
    SELECT "user", item, rating FROM ratings WHERE "user" = {PERSONAL_USER} AND rating > 0""", "ratings"))
def personal_ratings_filter(spark, sf_dir):
    return _personal(spark, sf_dir).select("user", "item", "rating")


@query("anti_join_candidates", T.with_views(f"""
    SELECT item, title FROM catalog WHERE item NOT IN
      (SELECT item FROM ratings WHERE "user" = {PERSONAL_USER} AND rating > 0)""", "ratings", "catalog"))
def anti_join_candidates(spark, sf_dir):
    return T.catalog(spark, sf_dir).join(_personal(spark, sf_dir).select("item"), "item", "left_anti")


@query("right_outer_join", T.with_views("""
    SELECT c.item, c.title, count(r.rating) AS n_ratings
    FROM (SELECT * FROM ratings WHERE rating >= 5) r RIGHT OUTER JOIN catalog c ON r.item = c.item
    GROUP BY c.item, c.title""", "ratings", "catalog"))
def right_outer_join(spark, sf_dir):
    """Every catalogue item with the number of its top ratings, also those without any."""
    top, c = T.ratings(spark, sf_dir).where("rating >= 5"), T.catalog(spark, sf_dir)
    joined = top.join(c, top["item"] == c["item"], "right_outer").select(c["item"], "title", "rating")
    return joined.groupBy("item", "title").agg(F.count("rating").alias("n_ratings"))


@query("user_candidate_pairs", T.with_views(f"""
    SELECT CAST({PERSONAL_USER} AS INTEGER) AS "user", item FROM catalog WHERE item NOT IN
      (SELECT item FROM ratings WHERE "user" = {PERSONAL_USER} AND rating > 0)""", "ratings", "catalog"))
def user_candidate_pairs(spark, sf_dir):
    cand = T.catalog(spark, sf_dir).join(_personal(spark, sf_dir).select("item"), "item", "left_anti")
    return cand.select(F.lit(PERSONAL_USER).cast("int").alias("user"), "item")


@query("top50_for_user", T.with_views("WITH " + _SPLIT + f""",
    tr AS (SELECT "user", item, rating FROM sp WHERE split = 'train'
           UNION ALL SELECT "user", item, rating FROM ratings WHERE "user" = {PERSONAL_USER} AND rating > 0),
    im AS (SELECT item, avg(rating) AS score FROM tr GROUP BY item),
    cand AS (SELECT c.item, c.title, im.score FROM catalog c JOIN im ON c.item = im.item
             WHERE c.item NOT IN (SELECT item FROM ratings WHERE "user" = {PERSONAL_USER} AND rating > 0)),
    top AS (SELECT * FROM cand ORDER BY score DESC, item LIMIT 50)
    SELECT CAST(row_number() OVER (ORDER BY score DESC, item) AS INTEGER) AS "rank", item,
           regexp_replace(title, '[^\\x00-\\x7F]', '', 'g') AS title, round(score, 6) AS score FROM top""",
    "ratings", "catalog"))
def top50_for_user(spark, sf_dir):
    sp = _split(spark, sf_dir)
    tr = sp.where(F.col("split") == "train").select("user", "item", "rating").unionByName(
        _personal(spark, sf_dir).select("user", "item", "rating"))
    model = tr.groupBy("item").agg(F.avg("rating").alias("score"))
    cand = (T.catalog(spark, sf_dir).join(_personal(spark, sf_dir).select("item"), "item", "left_anti")
            .join(model, "item"))
    top = cand.orderBy(F.desc("score"), "item").limit(50)   # distributed TakeOrdered
    w = Window.orderBy(F.desc("score"), "item")               # 50 rows only
    return top.select(F.row_number().over(w).alias("rank"), "item",
                      F.regexp_replace("title", r"[^\x00-\x7F]", "").alias("title"),
                      F.round("score", 6).alias("score"))


@query("topk_per_user", T.with_views("""
    WITH g AS (SELECT "user", item, avg(rating) AS avg_rating, count(*) AS n FROM ratings GROUP BY "user", item),
    r AS (SELECT *, row_number() OVER (PARTITION BY "user" ORDER BY avg_rating DESC, n DESC, item) AS "rank" FROM g)
    SELECT "user", "rank", item, round(avg_rating, 6) AS avg_rating, n FROM r WHERE "rank" <= 5""", "ratings"))
def topk_per_user(spark, sf_dir):
    g = T.ratings(spark, sf_dir).groupBy("user", "item").agg(F.avg("rating").alias("avg_rating"), F.count("*").alias("n"))
    t = top_k_per_group(g, ["user"], [F.desc("avg_rating"), F.desc("n"), F.col("item")], 5)
    return t.select("user", F.col("rank").cast("long").alias("rank"), "item",
                    F.round("avg_rating", 6).alias("avg_rating"), "n")


@query("topdecile_threshold", T.with_views("""
    WITH c AS (SELECT CAST(tstamp AS DATE) AS day, housing FROM customers),
    r AS (SELECT day, housing, row_number() OVER (PARTITION BY day ORDER BY housing DESC) AS rn,
                 count(*) OVER (PARTITION BY day) AS n FROM c)
    SELECT day, n, n // 10 AS k, max(CASE WHEN rn = n // 10 THEN housing END) AS kth FROM r GROUP BY day, n""",
    "customers"))
def topdecile_threshold(spark, sf_dir):
    c = T.customers(spark, sf_dir).select(F.to_date("tstamp").alias("day"), "housing")
    return kth_largest(c, ["day"], "housing").select("day", "n", "k", "kth")


@query("broadcast_title_lookup", T.with_views("""
    SELECT r."user", r.item, r.rating, c.title FROM ratings r JOIN catalog c ON r.item = c.item""",
    "ratings", "catalog"))
def broadcast_title_lookup(spark, sf_dir):
    # No hint: the catalogue grows with the data, so AQE broadcasts it only
    # when its measured size is under spark.sql.autoBroadcastJoinThreshold.
    return T.ratings(spark, sf_dir).join(T.catalog(spark, sf_dir), "item").select("user", "item", "rating", "title")


@query("limit_n", """SELECT event_id, ts, user_id, "value" FROM events ORDER BY ts, event_id LIMIT 1000""")
def limit_n(spark, sf_dir):
    e = T.table(spark, sf_dir, "events")
    return e.orderBy("ts", "event_id").limit(1000).select("event_id", "ts", "user_id", "value")


@query("order_by", T.with_views("""SELECT vehicle, ts, lat, lon FROM pings ORDER BY ts, vehicle""", "pings"))
def order_by(spark, sf_dir):
    return T.pings(spark, sf_dir).select("vehicle", "ts", "lat", "lon").orderBy("ts", "vehicle")


@query("select_alias", T.with_views("""
    SELECT vehicle AS "VehicleID", lat AS "Latitude", lon AS "Longitude", ts AS "TimeStamp", speed AS "Speed"
    FROM pings""", "pings"))
def select_alias(spark, sf_dir):
    p = T.pings(spark, sf_dir)
    return p.select(p.vehicle.alias("VehicleID"), p.lat.alias("Latitude"), p.lon.alias("Longitude"),
                    p.ts.alias("TimeStamp"), p.speed.alias("Speed"))


# ---------------------------------------------------------------- replay feed
# A replay feed: one ordered file per source (event type), line number =
# event id, timestamps at whole-hour resolution so that repeats occur.
_FEED = """feed AS (SELECT event_type AS source, event_id AS line_no,
    CAST(date_trunc('hour', ts) AS TIMESTAMP) AS ts FROM events)"""


def _feed(spark, sf_dir):
    e = T.table(spark, sf_dir, "events")
    return e.select(F.col("event_type").alias("source"), F.col("event_id").alias("line_no"),
                    F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("ts"))


@query("drop_repeat_timestamps", T.with_views("WITH " + _FEED + """
    SELECT source, line_no, ts FROM (
      SELECT *, lag(ts) OVER (PARTITION BY source ORDER BY line_no) AS prev FROM feed) x
    WHERE prev IS NULL OR ts <> prev"""))
def drop_repeat_timestamps(spark, sf_dir):
    from kestrel.operators.replay import drop_repeat_timestamps as drop
    return drop(_feed(spark, sf_dir), "source", "line_no", "ts")


@query("replay_schedule", T.with_views("WITH " + _FEED + """
    SELECT source, line_no, ts, gap_seconds, gap_seconds // 60 AS sleep_seconds FROM (
      SELECT *, epoch_us(ts) // 1000000 - lag(epoch_us(ts) // 1000000) OVER (PARTITION BY source ORDER BY line_no)
             AS gap_seconds FROM feed) x"""))
def replay_schedule(spark, sf_dir):
    from kestrel.operators.replay import replay_schedule as sched
    return sched(_feed(spark, sf_dir), "source", "line_no", "ts", speedup=60)
