"""SVM analysis run: scale, fit one model per kernel, compare,
project to 2-D, score a decision grid, cross-validate, report."""

from __future__ import annotations

import time
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from classbench.models.svm import KERNELS, fit_on_table
from classbench.operators import compare, curves, encode, metrics, projection, split
from classbench.plans.forest_run import CHURN_CATEGORICAL, CHURN_NUMERIC
from classbench.sources import fixtures as FX


def prepare_scaled(spark: SparkSession, sf_dir: str, test_size: float = 0.2):
    """F1 -> codes -> split (L1) -> population scaling fitted on train (E6) -> features.

    Returns (train, test, feature names); both frames have id, features, label.
    """
    f1 = FX.orders_churn(spark, sf_dir)
    enc = encode.fit_label_encoding(f1, CHURN_CATEGORICAL)
    d = enc.transform(f1).withColumn("label", F.col("Churn").cast("int"))
    parts = split.stratified_split(d, "id", "label", test_size, 42)
    parts = parts.persist()
    names = CHURN_CATEGORICAL + CHURN_NUMERIC
    train = parts.where(F.col("split") == "train")
    test = parts.where(F.col("split") == "test")
    scaler = encode.fit_population_scaler(train, names)
    out = []
    for part in (train, test):
        out.append(encode.assemble(scaler.transform(part), names).select("id", "features", "label"))
    return out[0], out[1], names


def prepare_ring(spark: SparkSession, sf_dir: str):
    """F3 split 80/20 (stratified), features (e0, e1) scaled on train."""
    r = FX.ring(spark, sf_dir)
    parts = split.stratified_split(r, "id", "label", 0.2, 42)
    parts = parts.persist()
    train = parts.where(F.col("split") == "train")
    test = parts.where(F.col("split") == "test")
    scaler = encode.fit_population_scaler(train, ["e0", "e1"])
    return [encode.assemble(scaler.transform(p), ["e0", "e1"]).select("id", "features", "label")
            for p in (train, test)]


def evaluate(model, test: DataFrame, name: str) -> DataFrame:
    """(model, metric, value) for accuracy, precision, recall, F1 and ROC-AUC."""
    scored = model.transform(test).withColumn("model", F.lit(name)).withColumn(
        "prediction", F.col("prediction").cast("int"))
    return metrics.grouped_binary_metrics(scored, ["model"], "label", "prediction", "score")


@dataclass
class SvmRun:
    models: dict
    tables: dict[str, DataFrame] = field(default_factory=dict)
    timings: dict[str, float] = field(default_factory=dict)


def run_svm_analysis(spark: SparkSession, sf_dir: str, kernels=("linear", "rbf", "poly"),
                     C: float = 1.0, n_landmarks: int = 128, max_iter: int = 100,
                     platt_folds: int = 5) -> SvmRun:
    """One model per kernel on F1; comparison (T8), best (K7), ROC per model (V9).

    One landmark table, with its folds, serves all kernels; the seconds of a kernel are those of its fit.
    """
    from classbench.models.kernel_svc import LandmarkTable

    train, test, _ = prepare_scaled(spark, sf_dir)
    table = LandmarkTable(train, platt_folds, n_landmarks)
    models, longs, timings, scored = {}, [], {}, []
    for k in kernels:
        t0 = time.time()
        models[k] = fit_on_table(table, k, C=C, max_iter=max_iter)
        timings[k] = time.time() - t0
        longs.append(evaluate(models[k], test, k))
        scored.append(models[k].transform(test).select(F.lit(k).alias("model"), "label", "score"))
    table.close()
    long = compare.union_all(*longs)
    seconds = spark.createDataFrame(list(timings.items()), "model string, train_seconds double")
    compared = compare.comparison_table(long).join(seconds, "model")
    tables = {"comparison": compared, "best": compare.best_row(compared, "f1", "model"),
              "roc": curves.roc_curve(compare.union_all(*scored), groups=["model"])}
    return SvmRun(models, tables, timings)


def _model_points(table, kernels) -> list:
    return [table.point(k, {}) for k in kernels]


def tuned_svms(train: DataFrame, kernels=KERNELS, folds: int = 5, n_landmarks: int = 128, max_iter: int = 100):
    """T1-T3 for every kernel: (fold scores, best parameters, {kernel: fitted model}); one landmark table for all.

    A model is its kernel's best point refitted on all rows, calibrated on the
    decisions of that point's folds.
    """
    from classbench.models.kernel_svc import KernelSVCModel, LandmarkTable, grid_fits, held_out_decisions
    from classbench.models.svm import _platt
    from classbench.plans.tuning import SVM_GRIDS, grid_points

    table, scores, best, models = LandmarkTable(train, folds, n_landmarks), [], [], {}
    for k in kernels:
        t0 = time.time()
        own, top, (*left_out, refit) = grid_fits(table, k, grid_points(SVM_GRIDS[k]), max_iter)
        platt = _platt(held_out_decisions(table, left_out), "label")
        models[k] = KernelSVCModel.of(refit.point, table.map_of(refit.point), refit.weights, platt, time.time() - t0)
        scores.append(own)
        best.append(top)
    table.close()
    return compare.union_all(*scores), compare.union_all(*best), models


def run_tuned_svm(spark: SparkSession, sf_dir: str, kernels=KERNELS, folds: int = 5, n_landmarks: int = 128) -> SvmRun:
    """E2 as it is run with tuning: grid search per kernel, best models compared on the test part, with seconds."""
    train, test, _ = prepare_scaled(spark, sf_dir)
    scores, best, models = tuned_svms(train, kernels, folds, n_landmarks)
    table = compare.comparison_table(compare.union_all(*[evaluate(m, test, k) for k, m in models.items()]))
    timings = {k: m.spec["train_seconds"] for k, m in models.items()}
    seconds = spark.createDataFrame(list(timings.items()), "model string, train_seconds double")
    table = table.join(seconds, "model")
    return SvmRun(models, {"grid": scores, "best_params": best, "comparison": table, "best": compare.best_row(table, "f1", "model")}, timings)


def svm_grid(spark: SparkSession, sf_dir: str, kernel: str, folds: int = 5, n_landmarks: int = 128) -> DataFrame:
    """T1-T3 of one kernel: (kernel, point, params, fold, f1, best), ``best`` marking the point of highest mean F1."""
    from classbench.models.kernel_svc import LandmarkTable, grid_search
    from classbench.plans.tuning import SVM_GRIDS, grid_points

    table = LandmarkTable(prepare_scaled(spark, sf_dir)[0], folds, n_landmarks)
    scores, best, _ = grid_search(table, kernel, grid_points(SVM_GRIDS[kernel]))
    table.close()
    chosen = ", ".join(f"{r['param']}={r['value']}" for r in sorted(best.collect(), key=lambda r: r["param"]))
    return scores.withColumn("best", F.col("params") == chosen)


def svm_cv_scores(spark: SparkSession, sf_dir: str, kernels=KERNELS, folds: int = 10, n_landmarks: int = 128) -> DataFrame:
    """T4 for SVMs: (model, fold, metric, value) of every kernel at its defaults; all fits run side by side."""
    from classbench.models.kernel_svc import LandmarkTable, fit_all, held_out_decisions
    from classbench.session import new_scratch_path

    table = LandmarkTable(prepare_scaled(spark, sf_dir)[0], folds, n_landmarks)
    points = _model_points(table, kernels)
    path = new_scratch_path(spark, "decisions")
    held_out_decisions(table, fit_all(table, points, list(range(folds)))).write.parquet(path)
    table.close()
    named = F.element_at(F.array(*[F.lit(k) for k in kernels]), F.col("point") + 1)
    scored = spark.read.parquet(path).select(named.alias("model"), "fold", "label", (F.col("decision") > 0).cast("int").alias("prediction"),
                                             F.col("decision").alias("score"))
    return metrics.grouped_binary_metrics(scored, ["model", "fold"], "label", "prediction", "score")


def svm_support_vectors(spark: SparkSession, sf_dir: str, kernels=KERNELS, n_landmarks: int = 128) -> DataFrame:
    """M8 of fitted models: (kernel, label, n_support, total, intercept) for every kernel at its defaults."""
    from classbench.models.kernel_svc import KernelSVCModel, LandmarkTable, fit_all

    train = prepare_scaled(spark, sf_dir)[0].persist()
    table = LandmarkTable(train, 0, n_landmarks)
    fitted = fit_all(table, _model_points(table, kernels), [-1])
    table.close()
    out = []
    for k, f in zip(kernels, fitted):
        model = KernelSVCModel.of(f.point, table.map_of(f.point), f.weights, (1.0, 0.0))
        out.append(model.support_vectors(train).select(F.lit(k).alias("kernel"), "label", "n_support", "total", "intercept"))
    train.unpersist()
    return compare.union_all(*out)
