"""Recommender queries (ALS): rows-only checks; MLlib does the solving."""

from __future__ import annotations

from pyspark.ml.recommendation import ALSModel
from pyspark.sql import Window
from pyspark.sql import functions as F

from kestrel.ml import recommend as RC
from kestrel.operators import stats as S
from kestrel.plans.registry import query
from kestrel.plans.relational import PERSONAL_USER
from kestrel.session import scratch_path, shared_dir
from kestrel.sources import tables as TB
from kestrel.streaming import jobs as J
from kestrel.streaming import runner as RN


def _splits(spark, sf_dir):
    shared_dir(spark)                       # ALS checkpoints its lineage there
    sp = S.split_by_digit(TB.ratings(spark, sf_dir)).select("user", "item", "rating", "ts", "split")
    return [sp.where(F.col("split") == s).drop("split") for s in ("train", "validation", "test")]


@query("als_train_predict")
def als_train_predict(spark, sf_dir):
    train, _, test = _splits(spark, sf_dir)
    model = RC.als(rank=8, max_iter=10, reg=0.1).fit(train)
    return model.transform(test).select("user", "item", "rating", F.round("prediction", 4).alias("prediction"))


@query("als_grid")
def als_grid(spark, sf_dir):
    train, val, test = _splits(spark, sf_dir)
    return RC.grid_search(spark, train, val, test).table


@query("als_implicit")
def als_implicit(spark, sf_dir):
    # implicit feedback: how often a user touched an item (view counts)
    views = TB.ratings(spark, sf_dir).groupBy("user", "item").agg(F.count("*").cast("double").alias("rating"))
    train, test = S.hash_split(views, ["user", "item"], [0.8, 0.2], seed=RC.SEED)
    model = RC.als(rank=10, max_iter=10, reg=0.01, implicit=True, alpha=0.01).fit(train)
    return model.transform(test).select("user", "item", "rating", F.round("prediction", 4).alias("prediction"))


@query("als_personal_top50")
def als_personal_top50(spark, sf_dir):
    train, _, _ = _splits(spark, sf_dir)
    mine = TB.ratings(spark, sf_dir).where((F.col("user") == PERSONAL_USER) & (F.col("rating") > 0))
    model = RC.als().fit(train.unionByName(mine))
    catalog = TB.catalog(spark, sf_dir)
    candidates = catalog.join(mine.select("item"), "item", "left_anti")
    return RC.top_n_for_user(model, PERSONAL_USER, candidates, 50, catalog)


@query("als_top5")
def als_top5(spark, sf_dir):
    train, _, test = _splits(spark, sf_dir)
    model = RC.als().fit(train)
    return RC.recommend_for(model, test.select("user"), 5, TB.catalog(spark, sf_dir))


@query("model_save_load")
def model_save_load(spark, sf_dir):
    train, _, test = _splits(spark, sf_dir)
    model = RC.als().fit(train)
    path = scratch_path(spark, "als-model")
    model.write().overwrite().save(path)
    loaded = ALSModel.load(path)
    a = model.transform(test).select("user", "item", F.col("prediction").alias("p_saved"))
    b = loaded.transform(test).select("user", "item", F.col("prediction").alias("p_loaded"))
    return a.join(b, ["user", "item"]).distinct().withColumn("equal", F.col("p_saved") == F.col("p_loaded"))


def _saved_model(spark, sf_dir):
    train, _, _ = _splits(spark, sf_dir)
    path = scratch_path(spark, "als-model")
    RC.als().fit(train).write().overwrite().save(path)
    return path


@query("stream_als_score")
def stream_als_score(spark, sf_dir):
    model = ALSModel.load(_saved_model(spark, sf_dir))
    src = scratch_path(spark, "rating-feed")
    staged = RN.stage_files(TB.rating_messages(spark, sf_dir), src, "ts", 5, fmt="text", text_col="value")
    stream = J.parse_rating_messages(RN.stream_source(spark, "files", path=f"{src}/*", max_files=staged.files))
    out = scratch_path(spark, "als-scores")

    def per_batch(batch, batch_id):
        if batch.isEmpty():
            return
        scored = model.transform(batch).withColumn("prediction", F.round("prediction", 1))
        scored.withColumn("absError", F.abs(F.col("prediction") - F.col("rating"))) \
            .write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    RN.run_available_now(stream, per_batch, scratch_path(spark, "als-score-ckpt"))
    return spark.read.parquet(out)


@query("recommendation_docs")
def recommendation_docs(spark, sf_dir):
    model = ALSModel.load(_saved_model(spark, sf_dir))
    catalog = TB.catalog(spark, sf_dir)
    src = scratch_path(spark, "rating-feed")
    staged = RN.stage_files(TB.rating_messages(spark, sf_dir), src, "ts", 5, fmt="text", text_col="value")
    stream = J.parse_rating_messages(RN.stream_source(spark, "files", path=f"{src}/*", max_files=staged.files))
    out = scratch_path(spark, "rec-docs")

    def per_batch(batch, batch_id):
        if batch.isEmpty():
            return
        docs = RC.recommendation_docs(RC.recommend_for(model, batch.select("user"), 5, catalog))
        # every rating of the batch gets its user's top 5, stamped with the rating time
        batch.select("tstamp", "user").join(docs, "user") \
            .write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    RN.run_available_now(stream, per_batch, scratch_path(spark, "rec-docs-ckpt"))
    return spark.read.parquet(out)


@query("random_split")
def random_split(spark, sf_dir):
    r = TB.ratings(spark, sf_dir)
    parts = r.randomSplit([0.8, 0.1, 0.1], seed=RC.SEED)
    tagged = [p.withColumn("part", F.lit(i)) for i, p in enumerate(parts)]
    out = tagged[0].unionByName(tagged[1]).unionByName(tagged[2])
    return out.groupBy("part").agg(F.count("*").alias("n"))


@query("bernoulli_sample")
def bernoulli_sample(spark, sf_dir):
    return TB.ratings(spark, sf_dir).sample(False, 0.5, 83)


# ---------------------------------------------------------------- checked skeletons of the learned results
_KNOWN_SQL = """sp AS (SELECT *, CASE WHEN (epoch_us(ts) // 1000000) % 10 < 6 THEN 'train'
        WHEN (epoch_us(ts) // 1000000) % 10 < 8 THEN 'validation' ELSE 'test' END AS split FROM ratings),
    tr AS (SELECT * FROM sp WHERE split = 'train'),
    te AS (SELECT * FROM sp WHERE split = 'test'),
    ok AS (SELECT * FROM te WHERE "user" IN (SELECT "user" FROM tr) AND item IN (SELECT item FROM tr))"""


@query("als_checks", TB.with_views("WITH " + _KNOWN_SQL + """
    SELECT 'predicted_rows' AS "check", count(*) AS n FROM ok
    UNION ALL SELECT 'finite_predictions', count(*) FROM ok
    UNION ALL SELECT 'loaded_model_differs', 0
    UNION ALL SELECT 'top5_users', count(DISTINCT "user") FROM te WHERE "user" IN (SELECT "user" FROM tr)
    UNION ALL SELECT 'top5_rows', count(DISTINCT "user") * (SELECT least(5, count(DISTINCT item)) FROM tr) FROM te
              WHERE "user" IN (SELECT "user" FROM tr)
    UNION ALL SELECT 'top5_out_of_order', 0""", "ratings"))
def als_checks(spark, sf_dir):
    """What must hold of one fit: who is scored, that a saved model scores alike, and the shape of the top five."""
    train, _, test = _splits(spark, sf_dir)
    model = RC.als().fit(train)
    path = scratch_path(spark, "als-model")
    model.write().overwrite().save(path)
    a = model.transform(test)
    b = ALSModel.load(path).transform(test)
    scored = a.agg(F.count("*").alias("predicted_rows"), F.count_if(F.abs("prediction") < 1e6).alias("finite_predictions"))
    pair = ["user", "item", "prediction"]
    differs = a.select(pair).exceptAll(b.select(pair)).agg(F.count("*").alias("loaded_model_differs"))
    top = RC.recommend_for(model, test.select("user"), 5, TB.catalog(spark, sf_dir))
    after = F.lag("rating").over(Window.partitionBy("user").orderBy("rank"))
    shape = top.withColumn("before", after).agg(
        F.countDistinct("user").alias("top5_users"), F.count("*").alias("top5_rows"),
        F.count_if(F.col("rating") > F.col("before")).alias("top5_out_of_order"))
    rows = [df.unpivot([], df.columns, "check", "n") for df in (scored, differs, shape)]
    return rows[0].unionAll(rows[1]).unionAll(rows[2])


@query("split_checks", """
    WITH u AS (SELECT event_id AS id, ('0x' || substr(md5('42:' || event_id), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0 AS u FROM events),
    p AS (SELECT *, CASE WHEN u < 0.8 THEN 0 WHEN u < 0.9 THEN 1 ELSE 2 END AS part FROM u)
    SELECT 'part ' || part AS "check", count(*) AS n, sum(id)::BIGINT AS ids FROM p GROUP BY part
    UNION ALL SELECT 'rows in one part exactly', count(*), sum(id)::BIGINT FROM p
    UNION ALL SELECT 'half', count(*), sum(id)::BIGINT FROM u WHERE u < 0.5""")
def split_checks(spark, sf_dir):
    """Sizes and id sums of the parts of a repeatable split, of the rows that are in one part, and of a half."""
    r = TB.table(spark, sf_dir, "events").select(F.col("event_id").alias("id"))
    weights = [0.8, 0.1, 0.1]
    total = weights[0] + weights[1] + weights[2]
    parts = S.hash_split(r, ["id"], [w / total for w in weights], seed=RC.SEED, portable=True)
    tagged = [p.select("id", F.lit(f"part {i}").alias("check")) for i, p in enumerate(parts)]
    every = tagged[0].unionAll(tagged[1]).unionAll(tagged[2])
    once = every.groupBy("id").count().where("count = 1").select("id", F.lit("rows in one part exactly").alias("check"))
    half = S.hash_split(r, ["id"], [0.5, 0.5], seed=RC.SEED, portable=True)[0].select("id", F.lit("half").alias("check"))
    return every.unionAll(once).unionAll(half).groupBy("check").agg(F.count("*").alias("n"), F.sum("id").alias("ids"))
