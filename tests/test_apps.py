"""End-to-end apps over inputs written in the original layouts (from the driver tables)."""

from pyspark.sql import functions as F

from kestrel import apps as A
from kestrel.plans.registry import QUERIES, load_all
from kestrel.session import scratch_path
from kestrel.sinks import files as W
from kestrel.sinks.index import read_index
from kestrel.sources import tables as TB
from kestrel.streaming import runner as RN

load_all()


def test_mileage_job_matches_registered_query(spark, sf_dir):
    root = scratch_path(spark, "mileage-inputs")
    p = TB.pings(spark, sf_dir)
    p.select(F.col("vehicle").alias("VehicleID"), F.col("lat").alias("Col3"), F.col("lon").alias("Col4"),
             F.col("ts").alias("TimeStamp"), F.col("speed").alias("Col6")).write.parquet(f"{root}/channel")
    c = TB.table(spark, sf_dir, "customer")
    W.write_csv(c.select(F.col("c_custkey").alias("RES"), F.col("c_nationkey").alias("RESGRP")), f"{root}/res",
                sep="¦")
    W.write_csv(TB.table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("RESGRP"),
                                                         F.col("n_regionkey").alias("FLEETID")), f"{root}/fleet", sep="¦")
    c.select(F.col("c_custkey").alias("ID"), F.col("c_custkey").cast("string").alias("VehicleNumber")) \
        .write.json(f"{root}/vehicle")
    got = A.mileage_job(spark, f"{root}/channel", f"{root}/res", f"{root}/fleet", f"{root}/vehicle",
                        out_csv=f"{root}/out")
    got = {r.vehicle_number: round(r.miles, 4) for r in got.collect()}
    want = {r.vehicle_number: r.miles for r in QUERIES["vehicle_mileage"](spark, sf_dir).collect()}
    assert got == want
    assert spark.read.option("header", True).csv(f"{root}/out").count() > 0


def test_als_tuning_job(spark, sf_dir):
    root = scratch_path(spark, "ml-dir")
    r = TB.ratings(spark, sf_dir).withColumn("ts", F.unix_timestamp("ts"))
    W.write_delimited_text(r, f"{root}/ratings.dat", ["user", "item", "rating", "ts"], "::")
    W.write_delimited_text(TB.catalog(spark, sf_dir), f"{root}/movies.dat", ["item", "title"], "::")
    W.write_delimited_text(r.where("user = 0"), f"{root}/mine", ["user", "item", "rating", "ts"], "::")
    out = A.als_tuning_job(spark, root, f"{root}/mine", model_out=f"{root}/model")
    assert out["grid"].count() == 8 and out["grid"].where("is_best").count() == 1
    recs = out["recommendations"].collect()
    assert len(recs) == 50 and [x["rank"] for x in recs] == list(range(1, 51))
    assert out["summary"].first()["n_ratings"] == r.count()


def test_risk_app_stream_equals_batch(spark, sf_dir):
    lines = TB.customer_lines(spark, sf_dir).withColumn(
        "ts", F.timestamp_seconds(F.split("line", "@\\|")[0].cast("long")))
    src = scratch_path(spark, "cust-src")
    RN.stage_files(lines, src, "ts", 4, fmt="text", text_col="line")
    idx = scratch_path(spark, "risk-index")
    q = A.risk_app(spark, RN.stream_source(spark, "files", path=f"{src}/*"), idx, scratch_path(spark, "risk-ck"),
                   slide_seconds=6 * 3600, window_slots=10)
    q.awaitTermination()
    flags = spark.read.parquet(f"{idx}/_risk_state/flags").drop("batch_id")
    recs = read_index(spark, idx, "customers/customer")
    assert recs.count() == lines.count()
    batch = A.risk_batch(A.parse_customer_messages(lines.select(F.col("line").alias("value"))), 6 * 3600, 10)
    key = ["tstamp", "nino", "risk_category", "cost"]
    assert sorted(map(tuple, flags.select(key).collect())) == sorted(map(tuple, batch.select(key).collect()))


def test_running_wordcount_app(spark, sf_dir):
    text = TB.table(spark, sf_dir, "conversations").select(F.regexp_replace("text", "\n", " ").alias("value"))
    src = scratch_path(spark, "wc-src")
    text.write.text(src)
    out = scratch_path(spark, "wc-out")
    A.wordcount_app(spark, RN.stream_source(spark, "files", path=src), out, scratch_path(spark, "wc-ck"),
                    sep=",", running=True).awaitTermination()
    got = {r.word: r["count"] for r in RN.read_changelog(spark, out, ["word"]).collect()}
    want = {r.word: r["count"] for r in text.select(F.explode(F.split("value", ",")).alias("word"))
            .groupBy("word").count().collect()}
    assert got == want


def test_churn_messages_parse(spark, sf_dir):
    c = TB.churn(spark, sf_dir)
    cols = [f.name for f in A.CHURN_SCHEMA.fields]
    msgs = c.select(F.to_json(F.array(*[(F.col(n) if n in c.columns else F.lit("x")).cast("string")
                                        for n in cols])).alias("value"))
    parsed = A.parse_churn_messages(msgs)
    assert parsed.count() == c.count()
    assert parsed.where(F.col("account_length").isNull()).count() == 0


def test_rating_stream_app_writes_three_resources(spark, sf_dir):
    from kestrel.ml import recommend as RC
    root = scratch_path(spark, "rs")
    train = TB.ratings(spark, sf_dir).select("user", "item", "rating")
    RC.als().fit(train).write().overwrite().save(f"{root}/model")
    W.write_delimited_text(TB.catalog(spark, sf_dir), f"{root}/movies", ["item", "title"], "::")
    src = f"{root}/feed"
    RN.stage_files(TB.rating_messages(spark, sf_dir), src, "ts", 3, fmt="text", text_col="value")
    idx = f"{root}/index"
    A.rating_stream_app(spark, RN.stream_source(spark, "files", path=f"{src}/*"), f"{root}/model",
                        f"{root}/movies", idx, f"{root}/ck").awaitTermination()
    n = TB.ratings(spark, sf_dir).count()
    assert read_index(spark, idx, "movies/ratingPrediction").count() == n
    assert read_index(spark, idx, "movies/rmse").count() == 3
    assert read_index(spark, idx, "movies/recommendations").count() == n


def test_rail_feed_app_and_current_graph(spark, sf_dir):
    from kestrel.sources.railfeed import rail_xml
    src = scratch_path(spark, "rail-src")
    rail_xml(spark, sf_dir).write.text(src)
    out = scratch_path(spark, "rail-out")
    A.rail_feed_app(spark, RN.stream_source(spark, "files", path=src), out, scratch_path(spark, "rail-ck")) \
        .awaitTermination()
    v, e, s = A.rail_current_graph(spark, out)
    assert v.count() == QUERIES["rail_current_state"](spark, sf_dir).count()
    assert e.count() == QUERIES["rail_current_edges"](spark, sf_dir).count()
    assert s.count() == QUERIES["rail_current_schedule_edges"](spark, sf_dir).count()


def test_tweets_job(spark, sf_dir):
    from kestrel.sources import tweets as TW
    pages = scratch_path(spark, "pages")
    TW.write_pages(TW.tweet_documents(spark, sf_dir), pages)
    got = A.tweets_job(spark, pages, scratch_path(spark, "tweets-out"))
    assert got.count() == TB.table(spark, sf_dir, "documents").count()


def test_tweet_pages_one_file_per_page_layout(spark, sf_dir):
    from kestrel.sources import tweets as TW
    pages = scratch_path(spark, "pages-files")
    TW.write_pages(TW.tweet_documents(spark, sf_dir), pages, one_file_per_page=True)
    got = A.tweets_job(spark, pages, scratch_path(spark, "tweets-out2"), one_file_per_page=True)
    assert got.count() == TB.table(spark, sf_dir, "documents").count()


def test_gzip_payloads_decode_and_broken_ones_are_null(spark):
    import gzip

    from kestrel.sources.gunzip import gunzip
    rows = [(bytearray(gzip.compress("<a x='é'/>".encode())),), (None,), (bytearray(b"plain"),)]
    got = [r.value for r in gunzip(spark.createDataFrame(rows, "value binary")).collect()]
    assert got == ["<a x='é'/>", None, None]


def test_churn_table_trains_both_models(spark, sf_dir):
    c = TB.churn(spark, sf_dir.replace("sf0.001", "sf0.01"))
    path = scratch_path(spark, "churn-table")
    c.select(*[(F.col(f.name) if f.name in c.columns else F.lit(None)).cast(f.dataType).alias(f.name)
               for f in A.CHURN_SCHEMA.fields]).write.parquet(f"{path}/batch_id=0")
    out = {r.model: r.auc for r in A.churn_train_job(spark, path).collect()}
    assert len(out) == 2 and all(0.5 < a <= 1 for a in out.values())


def test_listening_counts_job_sorts_its_predictions(spark):
    path = scratch_path(spark, "listening")
    spark.range(3000).selectExpr("concat_ws(' ', id % 40, id % 37, 1 + id % 5) AS value").distinct().write.text(path)
    rows = [(r.user, r.item) for r in A.listening_job(spark, path).collect()]
    assert rows and rows == sorted(rows)


def test_dropped_words_keep_a_running_total(spark):
    src, out = scratch_path(spark, "drop-src"), scratch_path(spark, "drop-out")
    for i, text in enumerate(["a b x", "c y a"]):
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(f"{src}/part={i}")
    A.wordcount_app(spark, RN.stream_source(spark, "files", path=f"{src}/*"), out, scratch_path(spark, "drop-ck")).awaitTermination()
    totals = [spark.read.parquet(f"{out}/_dropped/batch_id={i}").first().total for i in range(2)]
    assert totals == [2, 4]
    assert {r.word for r in spark.read.parquet(f"{out}/batch_id=0", f"{out}/batch_id=1").collect()} == {"x", "y"}


def test_risk_app_writes_both_risk_resources(spark, sf_dir):
    lines = TB.customer_lines(spark, sf_dir)
    src, idx = scratch_path(spark, "risk-lines"), scratch_path(spark, "risk-index")
    lines.select(F.col("line").alias("value")).coalesce(1).write.text(src)
    A.risk_app(spark, RN.stream_source(spark, "files", path=src), idx, scratch_path(spark, "risk-app-ck"),
               slide_seconds=6 * 3600, lateness_slots=200).awaitTermination()
    want = A.risk_batch(A.parse_customer_messages(lines.select(F.col("line").alias("value"))), 6 * 3600, 10)
    for category, (resource, field) in A.RISK_RESOURCES.items():
        got = sorted((r.tstamp, r.nino, r[field]) for r in read_index(spark, idx, resource).collect())
        assert got == sorted((r.tstamp, r.nino, r.cost) for r in want.where(F.col("risk_category") == category).collect())
