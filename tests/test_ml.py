"""ML checks: planted structure is learnt, persistence round-trips exactly."""

import random

from pyspark.sql import functions as F

from kestrel.ml import classify as CL
from kestrel.ml import recommend as RC
from kestrel.operators import stats as S
from kestrel.plans.registry import QUERIES, load_all
from kestrel.sources import tables as TB

load_all()


def test_save_load_predictions_equal(spark, sf_dir):
    out = QUERIES["model_save_load"](spark, sf_dir)
    assert out.count() > 0 and out.where(~F.col("equal")).count() == 0


def test_tree_and_forest_learn_the_planted_churn_label(spark):
    data = TB.churn(spark, "/root/testdata/sf0.01")
    tree = CL.fit_and_score(spark, data, CL.decision_tree()).first()["auc"]
    forest = CL.fit_and_score(spark, data, CL.random_forest()).first()["auc"]
    assert tree > 0.9 and forest > 0.8


def test_als_beats_mean_predictor_on_planted_low_rank_ratings(spark):
    rng = random.Random(0)
    u = [[rng.gauss(0, 1) for _ in range(2)] for _ in range(60)]
    v = [[rng.gauss(0, 1) for _ in range(2)] for _ in range(40)]
    rows = [(i, j, 3.0 + sum(a * b for a, b in zip(u[i], v[j]))) for i in range(60) for j in range(40)
            if rng.random() < 0.6]
    df = spark.createDataFrame(rows, "user int, item int, rating double")
    train, test = df.randomSplit([0.8, 0.2], seed=1)
    model = RC.als(rank=4, max_iter=15, reg=0.01).fit(train)
    rmse = RC.evaluate_rmse(model, test)
    mean = train.select(F.avg("rating")).first()[0]
    baseline = test.agg(F.sqrt(F.avg(F.pow(F.col("rating") - mean, 2)))).first()[0]
    assert rmse < 0.5 * baseline


def test_rmse_of_mean_predictor_is_population_stddev(spark, sf_dir):
    r = TB.ratings(spark, sf_dir).dropDuplicates(["user", "item"])
    mean = r.select(F.avg("rating")).scalar()
    preds = r.select("user", "item", mean.alias("prediction"))
    got = S.rmse(preds, r).first()["rmse"]
    sd = r.agg(F.stddev_pop("rating")).first()[0]
    assert abs(got - sd) < 1e-9


def test_split_counts_sum_to_total(spark, sf_dir):
    s = S.dataset_summary(S.split_by_digit(TB.ratings(spark, sf_dir))).first()
    assert s.n_train + s.n_validation + s.n_test == s.n_ratings


def test_hash_split_is_a_partition_and_repeatable(spark, sf_dir):
    r = TB.ratings(spark, sf_dir).select("user", "item", "rating", "ts").distinct()
    parts = S.hash_split(r, ["user", "item", "ts"], [0.8, 0.1, 0.1])
    counts = [p.count() for p in parts]
    assert sum(counts) == r.count() and counts[0] > counts[1]
    again = S.hash_split(r.repartition(7), ["user", "item", "ts"], [0.8, 0.1, 0.1])
    assert sorted(map(tuple, parts[1].collect())) == sorted(map(tuple, again[1].collect()))
