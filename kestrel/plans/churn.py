"""Churn family: feature table, correlation matrix, grouped quartiles, tree and forest AUC."""

from __future__ import annotations

from itertools import combinations_with_replacement

from pyspark.sql import functions as F

from kestrel.ml import classify as CL
from kestrel.operators.quantiles import exact_quantiles
from kestrel.operators.ranges import range_quantiles
from kestrel.plans.registry import query
from kestrel.sources import tables as TB
from kestrel.streaming import runner as RN

_NUM = TB.CHURN_NUMERIC
_PAIRS = list(combinations_with_replacement(range(len(_NUM)), 2))


_ALL_NUM = _NUM + ["number_customer_service_calls"]


@query("churn_features", TB.with_views(
    "SELECT customer, state, intl_plan, churned, " + ", ".join(f"round({c}, 6) AS {c}" for c in _ALL_NUM)
    + " FROM churn", "churn"))
def churn_features(spark, sf_dir):
    c = TB.churn(spark, sf_dir)
    return c.select("customer", "state", "intl_plan", "churned", *[F.round(x, 6).alias(x) for x in _ALL_NUM])


@query("correlation_matrix", TB.with_views(
    "WITH m AS (SELECT " + ", ".join(f"corr({_NUM[i]}, {_NUM[j]}) AS c{i}_{j}" for i, j in _PAIRS) + " FROM churn)\n"
    + "\nUNION ALL\n".join(f"SELECT '{_NUM[i]}' AS col_a, '{_NUM[j]}' AS col_b, round(c{i}_{j}, 6) AS r FROM m"
                           for i, j in _PAIRS), "churn"))
def correlation_matrix(spark, sf_dir):
    """Upper triangle (with diagonal) of the Pearson matrix, long form, in one aggregate pass."""
    c = TB.churn(spark, sf_dir)
    m = c.agg(*[F.corr(_NUM[i], _NUM[j]).alias(f"c{i}_{j}") for i, j in _PAIRS])
    stack = ", ".join(f"'{_NUM[i]}', '{_NUM[j]}', c{i}_{j}" for i, j in _PAIRS)
    long = m.selectExpr(f"stack({len(_PAIRS)}, {stack}) AS (col_a, col_b, r)")
    return long.select("col_a", "col_b", F.round("r", 6).alias("r"))


@query("grouped_quartiles", TB.with_views("""
    SELECT churned, count(*) AS n, min(number_customer_service_calls) AS "min",
           round(quantile_cont(number_customer_service_calls, 0.25), 4) AS q1,
           round(quantile_cont(number_customer_service_calls, 0.5), 4) AS median,
           round(quantile_cont(number_customer_service_calls, 0.75), 4) AS q3,
           max(number_customer_service_calls) AS "max" FROM churn GROUP BY churned""", "churn"))
def grouped_quartiles(spark, sf_dir):
    q = exact_quantiles(TB.churn(spark, sf_dir), ["churned"], "number_customer_service_calls",
                        {"q1": 0.25, "median": 0.5, "q3": 0.75})
    return q.select("churned", "n", "min", *[F.round(c, 4).alias(c) for c in ("q1", "median", "q3")], "max")


@query("quartiles_by_range", TB.with_views("""
    SELECT churned, count(*) AS n, min(total_day_charge) AS "min",
           round(quantile_cont(total_day_charge, 0.25), 4) AS q1, round(quantile_cont(total_day_charge, 0.5), 4) AS median,
           round(quantile_cont(total_day_charge, 0.75), 4) AS q3, max(total_day_charge) AS "max"
    FROM churn GROUP BY churned""", "churn"))
def quartiles_by_range(spark, sf_dir):
    """Exact quartiles of a column of (nearly) distinct doubles: no task holds a class's values."""
    q = range_quantiles(TB.churn(spark, sf_dir), ["churned"], "total_day_charge", {"q1": 0.25, "median": 0.5, "q3": 0.75})
    return q.select("churned", "n", "min", *[F.round(c, 4).alias(c) for c in ("q1", "median", "q3")], "max")


def _churn_once(spark, sf_dir):
    """The feature table, joined and aggregated once: indexers, classifiers and counts each read it anew."""
    return RN.materialize(spark, TB.churn(spark, sf_dir), "churn")


@query("churn_tree_auc")
def churn_tree_auc(spark, sf_dir):
    return CL.fit_and_score(spark, _churn_once(spark, sf_dir), CL.decision_tree())


@query("churn_forest_auc")
def churn_forest_auc(spark, sf_dir):
    return CL.fit_and_score(spark, _churn_once(spark, sf_dir), CL.random_forest())


@query("churn_checks", TB.with_views("""
    WITH u AS (SELECT *, ('0x' || substr(md5('42:' || customer), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0 AS u FROM churn),
    n AS (SELECT count(*) FILTER (u < 0.7) AS n_train, count(*) FILTER (u < 0.7 AND churned = 'True') AS churned_train,
                 count(*) FILTER (u >= 0.7) AS n_test, count(*) FILTER (u >= 0.7 AND churned = 'True') AS churned_test,
                 round(sum(total_day_charge) FILTER (u >= 0.7), 2) AS charge_test FROM u)
    SELECT model, n.*, true AS useful FROM n, (VALUES ('DecisionTreeClassifier'), ('RandomForestClassifier')) m(model)""", "churn"))
def churn_checks(spark, sf_dir):
    """Who trains and who is scored by each classifier, per class, and that both rank the scored ones better than chance."""
    data, out = _churn_once(spark, sf_dir), None
    yes = F.col("churned") == "True"
    for classifier in (CL.decision_tree(), CL.random_forest()):
        train, scored = CL.holdout_scores(data, classifier, ["customer"])
        name = F.lit(type(classifier).__name__).alias("model")
        auc = CL.auc_by(scored.withColumn("model", name), "model", yes)
        sizes = train.agg(F.count("*").alias("n_train"), F.count_if(yes).alias("churned_train")).join(
            scored.agg(F.count("*").alias("n_test"), F.count_if(yes).alias("churned_test"),
                       F.round(F.sum("total_day_charge"), 2).alias("charge_test")))
        row = sizes.join(auc).select("model", *sizes.columns, ((F.col("auc") > 0.5) & (F.col("auc") <= 1.0)).alias("useful"))
        out = row if out is None else out.unionAll(row)
    return out
