"""Churn classification: indexers + assembler + tree / forest, AUC on a holdout."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kestrel.operators.stats import hash_split

SEED = 42
# Feature columns used by the original classifier (fixed values).
REDUCED_NUMERIC = ["account_length", "number_vmail_messages", "total_day_calls", "total_day_charge",
                   "total_eve_calls", "total_eve_charge", "total_night_calls", "total_intl_calls",
                   "total_intl_charge"]


def pipeline(classifier) -> Pipeline:
    return Pipeline(stages=[
        StringIndexer(inputCol="intl_plan", outputCol="intl_plan_indexed", handleInvalid="keep"),
        StringIndexer(inputCol="churned", outputCol="label", stringOrderType="alphabetAsc"),
        VectorAssembler(inputCols=["intl_plan_indexed"] + REDUCED_NUMERIC, outputCol="features"),
        classifier])


def fit_and_score(spark: SparkSession, data: DataFrame, classifier, split=(0.7, 0.3)) -> DataFrame:
    train, test = hash_split(data, sorted(data.columns), list(split), seed=SEED)   # repeatable after a lost task
    model = pipeline(classifier).fit(train)
    auc = BinaryClassificationEvaluator(metricName="areaUnderROC").evaluate(model.transform(test))
    return spark.createDataFrame([(type(classifier).__name__, float(auc))], "model string, auc double")


def holdout_scores(data: DataFrame, classifier, keys: list[str], split=(0.7, 0.3)) -> tuple[DataFrame, DataFrame]:
    """(training rows, scored holdout rows) of a split by MD5 of ``keys``."""
    train, test = hash_split(data, keys, list(split), seed=SEED, portable=True)
    return train, churn_scores(pipeline(classifier).fit(train), test)


def fit_classifier(data: DataFrame, classifier):
    """The fitted pipeline, or None while the data hold fewer than two classes (nothing can be learned yet)."""
    if data.select("churned").where("churned IS NOT NULL").distinct().limit(2).count() < 2:
        return None
    return pipeline(classifier).fit(data)


def churn_scores(model: PipelineModel, data: DataFrame) -> DataFrame:
    """``data`` with ``score`` (probability of the label that sorts last) and ``predicted``; labels are not read."""
    known = PipelineModel([s for s in model.stages if s.hasParam("outputCol") is False or s.getOutputCol() != "label"])
    labels = next(s.labels for s in model.stages if s.hasParam("outputCol") and s.getOutputCol() == "label")
    scored = known.transform(data)
    return scored.select(*data.columns, vector_to_array("probability")[1].alias("score"),
                         F.element_at(F.array(*map(F.lit, labels)), F.col("prediction").cast("int") + 1).alias("predicted"))


def auc_by(scored: DataFrame, by: str, positive) -> DataFrame:
    """``<by>, auc``: area under the ROC curve of ``score`` per group, ties counted half; null without both classes.

    Rows are reduced to their distinct scores with class counts first.
    """
    counts = scored.groupBy(by, "score").agg(F.count_if(positive).alias("p"), F.count_if(~positive).alias("n"))
    below = Window.partitionBy(by).orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    wins = F.col("p") * (F.coalesce(F.sum("n").over(below), F.lit(0)) + F.col("n") / 2)
    return counts.withColumn("wins", wins).groupBy(by).agg(
        F.try_divide(F.sum("wins"), F.sum("p") * F.sum("n")).alias("auc"))


def decision_tree() -> DecisionTreeClassifier:
    return DecisionTreeClassifier(labelCol="label", featuresCol="features", seed=SEED)


def random_forest() -> RandomForestClassifier:
    return RandomForestClassifier(labelCol="label", featuresCol="features", numTrees=3, maxDepth=4,
                                  maxBins=32, impurity="gini", featureSubsetStrategy="auto", seed=SEED)
