"""Forest analysis run: load, profile, encode, split, fit,
tune, resample, evaluate, explain - each step a Spark job, results as DataFrames."""

from __future__ import annotations

import time
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from classbench.models.forest import forest, score
from classbench.operators import curves, encode, importance, metrics, profile, split
from classbench.sources import fixtures as FX

CHURN_CATEGORICAL = ["priority", "status", "segment"]
CHURN_NUMERIC = ["nation", "balance", "total"]


def prepare_churn(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list[str]]:
    """F1 -> label codes (E1, fitted on all rows as the reference does, Q1) ->
    0/1 label (P2) -> assembled features (E5).  Output (id, features, label)."""
    f1 = FX.orders_churn(spark, sf_dir)
    enc = encode.fit_label_encoding(f1, CHURN_CATEGORICAL)
    coded = enc.transform(f1).withColumn("label", F.col("Churn").cast("double"))
    names = CHURN_CATEGORICAL + CHURN_NUMERIC
    return encode.assemble(coded, names).select("id", "features", "label"), names


def _metric_rows(scored: DataFrame) -> DataFrame:
    long = metrics.grouped_binary_metrics(
        scored.withColumn("_g", F.lit(1)).withColumn("label", F.col("label").cast("int")),
        ["_g"], "label", "prediction", "score")
    return long.select("metric", F.col("value").cast("double").alias("value"))


def flagship_metrics(spark: SparkSession, sf_dir: str, num_trees: int = 100,
                     max_depth: int | None = None) -> DataFrame:
    """Minimum slice: F1 -> E1 -> L1 -> forest -> test metrics (metric, value)."""
    data, _ = prepare_churn(spark, sf_dir)
    parts = split.stratified_split(data, "id", "label", 0.2, 42)
    parts = parts.persist()
    train = parts.where(F.col("split") == "train")
    test = parts.where(F.col("split") == "test")
    model = forest(num_trees, max_depth).grow(train)
    return _metric_rows(score(model, test))


@dataclass
class RunResult:
    """Everything a forest run produces; DataFrames stay lazy until read."""

    model: object
    feature_names: list[str]
    tables: dict[str, DataFrame] = field(default_factory=dict)
    timings: dict[str, float] = field(default_factory=dict)
    persisted: list[DataFrame] = field(default_factory=list)

    def close(self):
        for d in self.persisted:
            d.unpersist()


def run_complete_analysis(spark: SparkSession, sf_dir: str, num_trees: int = 100,
                          max_depth: int | None = None, grid: dict | None = None,
                          cv_folds: int = 10, tune_folds: int = 5, parallelism: int = 2) -> RunResult:
    """The full forest workflow.  ``grid`` (dict of lists) enables tuning (T1);
    the default skips it, as the 216-point grid is over a thousand fits."""
    from classbench.plans.tuning import cv_scores, grid_points

    t = {}
    f1 = FX.orders_churn(spark, sf_dir)
    tables = {"shape": profile.shape(f1), "class_share": profile.class_share(f1, "Churn")}
    data, names = prepare_churn(spark, sf_dir)
    parts = split.stratified_split(data, "id", "label", 0.2, 42)
    parts = parts.persist()
    train = parts.where(F.col("split") == "train").drop("split")
    test = parts.where(F.col("split") == "test").drop("split")
    t0 = time.time()
    model = forest(num_trees, max_depth).fit(train)
    t["baseline_fit"] = time.time() - t0
    if grid:
        from classbench.models.forest import forest as mk
        folded = split.stratified_kfold(train, "id", "label", tune_folds, 42).persist()
        best, best_score, rows = None, -1.0, []
        for i, p in enumerate(grid_points(grid)):
            long = cv_scores(lambda p=p: mk(p.get("n_estimators", 100), p.get("max_depth"),
                                             p.get("min_samples_split", 2), p.get("min_samples_leaf", 1),
                                             p.get("max_features", "sqrt"), approximate=True),
                             folded, tune_folds, model_name=str(i), score_fn=score)
            f1s = long.where(F.col("metric") == "f1").agg(F.avg("value")).first()[0]
            rows.append((str(i), repr(p), float(f1s)))
            if f1s > best_score:
                best, best_score = p, f1s
        schema = StructType([StructField("point", StringType()), StructField("params", StringType()),
                             StructField("mean_f1", DoubleType())])
        tables["grid"] = spark.createDataFrame(rows, schema)
        model = mk(best.get("n_estimators", 100), best.get("max_depth"), best.get("min_samples_split", 2),
                   best.get("min_samples_leaf", 1), best.get("max_features", "sqrt"),
                   approximate=True).fit(train)
        folded.unpersist()
    scored = score(model, test)
    tables["test_metrics"] = _metric_rows(scored)
    tables["confusion"] = metrics.confusion_matrix(scored.withColumn("label", F.col("label").cast("int")))
    tables["roc"] = curves.roc_curve(scored)
    tables["pr"] = curves.pr_curve(scored)
    tables["probability_hist"] = profile.histogram(scored, "score", 30, group="label")
    imp = importance.importance_table(spark, names, model.featureImportances)
    tables["importance"] = importance.ranked(imp)
    tables["importance_needed"] = importance.needed_for(imp)
    if cv_folds:
        folded = split.stratified_kfold(train, "id", "label", cv_folds, 42)
        tables["cv"] = cv_scores(lambda: forest(num_trees, max_depth), folded, cv_folds,
                                 model_name="forest", score_fn=score)
    return RunResult(model, names, tables, t, [parts])
