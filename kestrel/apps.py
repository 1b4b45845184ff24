"""End-to-end applications over the original input formats.

Each function wires a source in the original layout (MovieLens ``::`` files,
``¦``-delimited fleet tables, JSON vehicle lists, parquet position channels,
``@|``/``,``-delimited messages on Kafka, a socket or files, rail XML) to the
operators of this package and writes the same kinds of outputs.  Streaming
apps take ``processing_time`` (``"1 second"``, ``"10 seconds"``) for long
runs; without it they process what is available and stop.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel.functions.parse import name_fields, split_literal, typed_customer
from kestrel.functions.timecols import on_rounded_day
from kestrel.ml import recommend as RC
from kestrel.operators import mileage as M
from kestrel.operators import rail as RL
from kestrel.operators import stats as S
from kestrel.operators.risk import CHILDCARE, HOUSING, risk_flags
from kestrel.session import path_exists, shared_dir
from kestrel.sinks import files as W
from kestrel.sinks.index import index_writer
from kestrel.sources import readers as R
from kestrel.sources import tweets as TW
from kestrel.sources.gunzip import gunzip
from kestrel.sources.tables import CUSTOMER_DELIM, CUSTOMER_FIELDS
from kestrel.streaming import jobs as J
from kestrel.ml.store import ModelStore
from kestrel.streaming import runner as RN
from kestrel.streaming.railstate import RailGraph, rail_batch_fn
from kestrel.streaming.refresh import refreshed_model
from kestrel.streaming.risk import risk_flag_batch_fn


# ---------------------------------------------------------------- telematics
def mileage_job(spark: SparkSession, channel_path: str, resource_path: str, fleet_path: str,
                vehicle_path: str, out_csv: str | None = None, day: str | None = None,
                class_range: tuple[int, int] | None = None) -> DataFrame:
    """Miles per vehicle from a position channel (parquet: VehicleID, Col3 lat, Col4 lon,
    TimeStamp, Col6 speed), resource/fleet DSV tables and a JSON vehicle list."""
    resource = R.read_dsv_infer(spark, resource_path)
    fleet = R.read_dsv_infer(spark, fleet_path)
    vehicle = spark.read.json(vehicle_path)
    fleet_res = resource.join(fleet, "RESGRP").select(
        F.col("RES").cast("string").alias("res"), F.col("RESGRP").alias("class"), F.col("FLEETID").alias("fleet_id"))
    dim = vehicle.join(fleet_res, vehicle["VehicleNumber"].cast("string") == fleet_res["res"]).select(
        F.col("ID").alias("id"), F.col("VehicleNumber").cast("int").alias("vehicle_number"), "class", "fleet_id")
    ch = spark.read.parquet(channel_path).select(
        F.col("VehicleID").alias("vehicle"), F.col("TimeStamp").cast("timestamp_ntz").alias("ts"),
        F.col("Col3").cast("double").alias("lat"), F.col("Col4").cast("double").alias("lon"),
        F.col("Col6").cast("double").alias("speed"))
    if day:
        ch = ch.where(on_rounded_day("ts", day))
    if class_range:
        dim = dim.where(F.col("class").between(*class_range))
    segs = M.segments(M.dedupe_min_latitude(M.clean_pings(ch, dim)))
    miles = M.vehicle_mileage(segs)
    if out_csv:
        W.write_csv(segs.drop("bucket"), out_csv, header=True)
    return miles


# ---------------------------------------------------------------- recommender
def als_tuning_job(spark: SparkSession, movielens_dir: str, personal_ratings_path: str | None,
                   model_out: str | None = None, top_n: int = 50) -> dict:
    """``ratings.dat`` / ``movies.dat`` (``::``): counts, 60/20/20 split by the last
    digit of the timestamp, 8-fit grid, test RMSE, baseline improvement, personal top-N."""
    shared_dir(spark)
    ratings = R.read_ratings(spark, f"{movielens_dir}/ratings.dat")
    movies = R.read_catalog(spark, f"{movielens_dir}/movies.dat")
    r = ratings.withColumn("split", F.when(F.col("bucket") < 6, "train")
                           .when(F.col("bucket") < 8, "validation").otherwise("test"))
    train = r.where(F.col("split") == "train").select("user", "item", "rating")
    mine = None
    if personal_ratings_path:
        mine = R.load_personal_ratings(spark, personal_ratings_path).select("user", "item", "rating")
        train = train.unionByName(mine)
    val = r.where(F.col("split") == "validation").select("user", "item", "rating")
    test = r.where(F.col("split") == "test").select("user", "item", "rating")
    grid = RC.grid_search(spark, train, val, test)
    if model_out:
        grid.best.write().overwrite().save(model_out)
    mean = train.unionByName(val).select(F.avg("rating")).scalar()
    base = test.agg(F.sqrt(F.avg(F.pow(mean - F.col("rating"), 2))).alias("baseline_rmse"))
    out = {"summary": S.dataset_summary(r), "grid": grid.table, "baseline": base}
    if mine is not None:
        me = mine.select(F.first("user")).first()[0]
        candidates = movies.join(mine.select("item"), "item", "left_anti")
        out["recommendations"] = RC.top_n_for_user(grid.best, me, candidates, top_n, movies)
    return out


def implicit_job(spark: SparkSession, views_csv: str, model_out: str | None = None) -> DataFrame:
    """Implicit ALS over a viewing log (CSV with header; columns 1 and 2 = show, user)."""
    raw = spark.read.option("header", True).csv(views_csv)
    v = raw.select(F.col(raw.columns[1]).cast("int").alias("item"), F.col(raw.columns[2]).cast("int").alias("user"))
    counts = v.groupBy("user", "item").agg(F.count("*").cast("double").alias("rating"))
    train, test = S.hash_split(counts, ["user", "item"], [0.8, 0.2], seed=RC.SEED)
    model = RC.als(rank=10, max_iter=10, reg=0.01, implicit=True, alpha=0.01).fit(train)
    if model_out:
        model.write().overwrite().save(model_out)
    return model.transform(test)


def rating_stream_app(spark: SparkSession, source: DataFrame, model_path: str, movies_path: str,
                      index_root: str, checkpoint: str, processing_time: str | None = None, movies_sep: str = "::"):
    """Score ``tstamp,user,item,rating`` messages with a saved model; write prediction
    documents, per-batch error and per-user top-5 to ``movies/*`` resources."""
    from pyspark.ml.recommendation import ALSModel
    model = ALSModel.load(model_path)
    movies = RN.materialize(spark, R.read_catalog(spark, movies_path, movies_sep), "movies")
    preds_w = index_writer(index_root, "movies/ratingPrediction")
    rmse_w = index_writer(index_root, "movies/rmse")
    recs_w = index_writer(index_root, "movies/recommendations")

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        batch = batch.persist()
        try:
            score_batch(batch, batch_id)
        finally:
            batch.unpersist()

    def score_batch(batch: DataFrame, batch_id: int) -> None:
        scored = model.transform(batch).withColumn("prediction", F.round("prediction", 1))
        preds_w(J.error_docs(scored, movies), batch_id)
        se = F.pow(F.col("prediction") - F.col("rating"), 2)
        rmse_w(scored.agg(F.avg(se).alias("mse"), F.sqrt(F.avg(se)).alias("rmse"),
                          F.stddev_pop("rating").alias("baseline_rmse")), batch_id)
        docs = RC.recommendation_docs(RC.recommend_for(model, batch.select("user"), 5, movies))
        recs_w(batch.select("tstamp", "user").join(docs, "user"), batch_id)

    return RN.start(J.parse_rating_messages(source), per_batch, checkpoint, processing_time=processing_time)


# ---------------------------------------------------------------- risk flags
def parse_customer_messages(values: DataFrame) -> DataFrame:
    """``@|``-delimited customer messages → typed records (tstamp as epoch seconds)."""
    named = name_fields(values.withColumn("_p", split_literal("value", CUSTOMER_DELIM)), "_p", CUSTOMER_FIELDS)
    return typed_customer(named)


# Resource and cost field of each category in the risk index (fixed by the original mappings).
RISK_RESOURCES = {HOUSING: ("risks/topCentileHousingCosts", "housingCosts"),
                  CHILDCARE: ("risks/topCentileChildCareCosts", "childCareCosts")}


def risk_app(spark: SparkSession, source: DataFrame, index_root: str, checkpoint: str,
             slide_seconds: int = 1, window_slots: int = 10, lateness_slots: int = 0,
             processing_time: str | None = None):
    """Index every customer record, and every top-decile housing or child-care cost in its risk resource.

    ``lateness_slots`` slots of disorder are awaited; rows further behind are
    kept under ``_risk_state/late``.
    """
    cust_w = index_writer(index_root, "customers/customer")
    writers = {c: index_writer(index_root, resource) for c, (resource, _) in RISK_RESOURCES.items()}

    def index_flags(flags: DataFrame, batch_id: int) -> None:
        for category, (_, field) in RISK_RESOURCES.items():
            writers[category](flags.where(F.col("risk_category") == category).select(
                "tstamp", "nino", "risk_category", F.col("cost").alias(field)), batch_id)
    flags_fn = risk_flag_batch_fn(spark, f"{index_root}/_risk_state", slide_seconds, window_slots, lateness_slots,
                                  flag_sink=index_flags)

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        recs = parse_customer_messages(batch).persist()
        try:
            if not recs.isEmpty():
                cust_w(recs, batch_id)
            flags_fn(recs.select("tstamp", "nino", F.col("housingCosts").alias("housing"),
                                 F.col("childCareCosts").alias("childcare")), batch_id)
        finally:
            recs.unpersist()

    return RN.start(source, per_batch, checkpoint, processing_time=processing_time)


def risk_batch(customers: DataFrame, slide_seconds: int = 1, window_slots: int = 10) -> DataFrame:
    """Batch form over typed records (``tstamp, nino, housingCosts, childCareCosts``)."""
    c = customers.select("tstamp", "nino", F.col("housingCosts").alias("housing"),
                         F.col("childCareCosts").alias("childcare"))
    return risk_flags(c, slide_seconds, window_slots)


# ---------------------------------------------------------------- word counts
def wordcount_app(spark: SparkSession, source: DataFrame, out: str, checkpoint: str, sep: str = " ",
                  running: bool = False, processing_time: str | None = None):
    """Per-batch counts (with the batch time, block-listed words dropped) or a running count per word
    (``running=True``).

    The first also keeps ``_dropped/``: per batch the dropped words' count and
    their running total over all batches.
    """
    lines = source.select(F.col("value").alias("text"))
    if running:
        agg = J.running_word_count(lines, sep)
        return RN.start(agg, RN.batch_partition_writer(out), checkpoint, mode="update",
                        processing_time=processing_time)

    totals = f"{out}/_dropped"

    def echo(batch: DataFrame, batch_id: int) -> None:
        counts = J.words(batch, sep).groupBy("word").agg(
            F.count("*").alias("count"), F.max(F.col("word").isin(J.BLOCKLIST)).alias("dropped")).withColumn(
            "batch_time", F.current_timestamp()).persist()
        try:
            counts.where("NOT dropped").write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")
            now = counts.where("dropped").agg(F.coalesce(F.sum("count"), F.lit(0))).first()[0]
        finally:
            counts.unpersist()
        before = f"{totals}/batch_id={batch_id - 1}"               # every batch writes its total
        total = spark.read.parquet(before).first()["total"] if batch_id and path_exists(spark, before) else 0
        spark.createDataFrame([(now, total + now)], "dropped long, total long").write.mode("overwrite").parquet(
            f"{totals}/batch_id={batch_id}")

    return RN.start(lines, echo, checkpoint, processing_time=processing_time)


# ---------------------------------------------------------------- rail feed, tweets, churn
def rail_feed_app(spark: SparkSession, source: DataFrame, out_root: str, checkpoint: str,
                  processing_time: str | None = None, gzipped: bool = False):
    """Parse each micro-batch of rail XML once and append typed tables:
    ``forecast_edges/``, ``schedule_edges/``, ``vertex_events/`` (batch-partitioned,
    idempotent on replay).  ``rail_current_graph`` derives the live graph."""
    if gzipped:                                                    # payloads as the push feed sends them
        source = gunzip(source)

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        parsed = RL.parse_messages(batch).persist()
        try:
            for name, df in (("forecast_edges", RL.forecast_edges(parsed)),
                             ("schedule_edges", RL.schedule_edges(parsed)),
                             ("vertex_events", RL.vertex_events(parsed))):
                df.write.mode("overwrite").parquet(f"{out_root}/{name}/batch_id={batch_id}")
        finally:
            parsed.unpersist()

    return RN.start(source, per_batch, checkpoint, processing_time=processing_time)


def rail_current_graph(spark: SparkSession, out_root: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Live vertices, forecast edges and schedule edges from the typed feed tables."""
    events, forecasts, schedules = (spark.read.parquet(f"{out_root}/{t}").drop("batch_id")
                                    for t in ("vertex_events", "forecast_edges", "schedule_edges"))
    return RL.latest_vertices(events), RL.latest_edges(forecasts, events), RL.latest_edges(schedules, events)


def rail_graph_app(spark: SparkSession, source: DataFrame, root: str, checkpoint: str, processing_time: str | None = None,
                   gzipped: bool = False, every: int = 10):
    """Keep the live rail graph under ``root`` up to date; read it with ``RailGraph(spark, root)`` at any time."""
    step = rail_batch_fn(RailGraph(spark, root, every))
    return RN.start(gunzip(source) if gzipped else source, step, checkpoint, processing_time=processing_time)


def churn_train_job(spark: SparkSession, table_path: str) -> DataFrame:
    """Train the tree and the forest on the table that ``churn_app`` appends to; ``model, auc`` on the holdout."""
    from kestrel.ml import classify as CL
    rows = spark.read.parquet(table_path).drop("batch_id").where(F.col("churned").isNotNull())
    tree, forest = (CL.fit_and_score(spark, rows, c) for c in (CL.decision_tree(), CL.random_forest()))
    return tree.unionByName(forest)


def listening_job(spark: SparkSession, counts_path: str) -> DataFrame:
    """Implicit ALS (5 iterations, reg 0.01) over space-delimited ``user item count`` lines.

    Returns the predictions for the held-out pairs, sorted by user.
    """
    shared_dir(spark)
    p = split_literal("value", " ")
    rows = spark.read.text(counts_path).select(
        F.try_element_at(p, F.lit(1)).try_cast("int").alias("user"), F.try_element_at(p, F.lit(2)).try_cast("int").alias("item"),
        F.try_element_at(p, F.lit(3)).try_cast("double").alias("rating")).dropna()
    train, test = S.hash_split(rows, ["user", "item"], [0.8, 0.2], seed=RC.SEED)
    model = RC.als(rank=10, max_iter=5, reg=0.01, implicit=True).fit(train)
    return model.transform(test).orderBy("user", "item")


def tweets_job(spark: SparkSession, pages_path: str, out_path: str, one_file_per_page: bool = False) -> DataFrame:
    """Search-result pages (JSON arrays) → flat, de-duplicated tweets written as JSON."""
    flat = TW.flatten(TW.read_pages(spark, pages_path, one_file_per_page)).dropDuplicates(["id"])
    flat.write.mode("overwrite").json(out_path)
    return spark.read.json(out_path)


# The 21 fields of a churn message, in the order of the wire format (fixed values).
CHURN_FIELDS = """
    state string, account_length double, area_code string, phone_number string, intl_plan string, voice_mail_plan string,
    number_vmail_messages double, total_day_minutes double, total_day_calls double, total_day_charge double,
    total_eve_minutes double, total_eve_calls double, total_eve_charge double, total_night_minutes double,
    total_night_calls double, total_night_charge double, total_intl_minutes double, total_intl_calls double,
    total_intl_charge double, number_customer_service_calls double, churned string"""
_TYPES = {"string": T.StringType(), "double": T.DoubleType()}
CHURN_SCHEMA = T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in map(str.split, CHURN_FIELDS.split(","))])


def parse_churn_messages(values: DataFrame) -> DataFrame:
    """JSON-array messages (one churn record each) → typed rows."""
    arr = F.from_json("value", "array<string>")
    return values.select(*[F.try_element_at(arr, F.lit(i + 1)).cast(f.dataType).alias(f.name)
                           for i, f in enumerate(CHURN_SCHEMA.fields)])


def churn_app(spark: SparkSession, source: DataFrame, table_path: str, checkpoint: str,
              processing_time: str | None = None):
    """Append incoming churn records to a table; train with ``kestrel.ml.classify`` on it."""
    return RN.start(parse_churn_messages(source), RN.batch_partition_writer(table_path), checkpoint,
                    processing_time=processing_time)


def rating_refresh_app(spark: SparkSession, source: DataFrame, root: str, checkpoint: str,
                       processing_time: str | None = None, over: str = "history"):
    """Score every rating with the model of the batches before its own, then refit with its batch.

    ``root/history`` keeps the ratings per batch, ``root/scores`` the scored ones
    with the version that scored them, ``root/model`` the versions.
    """
    from pyspark.ml.recommendation import ALSModel

    def fit(rows: DataFrame):
        rows = rows.dropna(subset=["user", "item", "rating"])
        return None if rows.isEmpty() else RC.als().fit(rows)

    def score(model, batch: DataFrame) -> DataFrame:
        scored = model.transform(batch.dropna(subset=["user", "item"])).withColumn("prediction", F.round("prediction", 1))
        return scored.withColumn("absError", F.abs(F.col("prediction") - F.col("rating")))
    step = refreshed_model(ModelStore(spark, f"{root}/model", ALSModel.load), f"{root}/history", fit, score,
                           f"{root}/scores", over)
    return RN.start(J.parse_rating_messages(source), step, checkpoint, processing_time=processing_time)


def churn_refresh_app(spark: SparkSession, source: DataFrame, root: str, checkpoint: str,
                      processing_time: str | None = None, over: str = "history", classifier=None):
    """Score every churn record with the classifier of the batches before its own, then refit with its batch.

    Layout as in :func:`rating_refresh_app`; ``kestrel.ml.classify.auc_by`` over
    ``root/scores`` gives the AUC of every batch on records that its model had not seen.
    """
    from pyspark.ml import PipelineModel

    from kestrel.ml import classify as CL

    def fit(rows: DataFrame):
        return CL.fit_classifier(rows.where("churned IS NOT NULL"), classifier or CL.decision_tree())
    step = refreshed_model(ModelStore(spark, f"{root}/model", PipelineModel.load), f"{root}/history", fit, CL.churn_scores,
                           f"{root}/scores", over)
    return RN.start(parse_churn_messages(source), step, checkpoint, processing_time=processing_time)


__all__ = ["rail_graph_app", "rating_refresh_app", "churn_refresh_app", "mileage_job", "als_tuning_job", "implicit_job", "rating_stream_app", "risk_app", "risk_batch",
           "wordcount_app", "rail_feed_app", "rail_current_graph", "tweets_job", "churn_app",
           "parse_customer_messages", "parse_churn_messages", "churn_train_job", "listening_job"]
