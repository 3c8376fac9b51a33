import math

import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from classbench.operators import curves, metrics
from classbench.sources import fixtures as FX
from tests.conftest import SF_SMALL


def test_confusion_keeps_zero_cells(spark):
    df = spark.createDataFrame([(0, 0), (0, 0), (2, 0)], "label int, prediction int")
    cm = {(r["actual"], r["predicted"]): r["count"] for r in metrics.confusion_matrix(df).collect()}
    assert cm == {(0, 0): 2, (0, 2): 0, (2, 0): 1, (2, 2): 0}


def test_no_predicted_positive_gives_zero(spark):
    df = spark.createDataFrame([(1, 0), (0, 0)], "label int, prediction int")
    r = metrics.binary_metrics(df).first()
    assert (r["precision"], r["recall"], r["f1"], r["accuracy"]) == (0.0, 0.0, 0.0, 0.5)


def test_report_rows(spark):
    df = spark.createDataFrame([(0, 0), (0, 1), (1, 1), (2, 2), (2, 0)], "label int, prediction int")
    rep = {r["row"]: r for r in metrics.classification_report(df, names={0: "zero"}).collect()}
    assert set(rep) == {"zero", "1", "2", "accuracy", "macro avg", "weighted avg"}
    assert rep["accuracy"]["f1"] == pytest.approx(3 / 5) and rep["accuracy"]["precision"] is None
    assert rep["1"]["precision"] == pytest.approx(0.5) and rep["1"]["recall"] == 1.0
    w = metrics.weighted_metrics(df).first()
    assert w["recall"] == pytest.approx(3 / 5)


def test_auc_matches_exact_evaluator_and_bucketed_path(spark):
    f4 = FX.scored(spark, SF_SMALL)
    ours = curves.roc_auc(f4).first()[0]
    bucketed = curves.roc_auc(f4, rows_per_bucket=7).first()[0]
    ev = BinaryClassificationEvaluator(rawPredictionCol="raw", labelCol="label", numBins=0)
    raw = f4.select(F.col("label").cast("double").alias("label"),
                    array_to_vector(F.array(-F.col("score"), F.col("score"))).alias("raw"))
    assert ours == pytest.approx(ev.evaluate(raw), abs=1e-12)
    assert bucketed == pytest.approx(ours, abs=1e-12)


def test_roc_monotone_and_pr_end(spark):
    f4 = FX.scored(spark, SF_SMALL)
    roc = sorted(curves.roc_curve(f4, rows_per_bucket=5).collect(), key=lambda r: -r["threshold"])
    assert roc[0]["threshold"] == math.inf and (roc[0]["fpr"], roc[0]["tpr"]) == (0.0, 0.0)
    fprs = [r["fpr"] for r in roc]
    tprs = [r["tpr"] for r in roc]
    assert fprs == sorted(fprs) and tprs == sorted(tprs) and fprs[-1] == 1.0 and tprs[-1] == 1.0
    pr = curves.pr_curve(f4).collect()
    end = [r for r in pr if r["threshold"] is None]
    assert len(end) == 1 and end[0]["precision"] == 1.0 and end[0]["recall"] == 0.0


def test_auc_single_class_is_null(spark):
    df = spark.createDataFrame([(1, 0.3), (1, 0.9)], "label int, score double")
    assert curves.roc_auc(df).first()[0] is None


def test_loss_accuracy(spark):
    df = spark.createDataFrame([(0, [0.9, 0.1]), (1, [0.4, 0.6])], "label int, p array<double>")
    r = metrics.loss_accuracy(df, "label", "p").first()
    assert r["loss"] == pytest.approx(-(math.log(0.9) + math.log(0.6)) / 2)
    assert r["accuracy"] == 1.0
    b = spark.createDataFrame([(1, 1.0), (0, 0.2)], "label int, p double")
    rb = metrics.binary_loss_accuracy(b, "label", "p").first()
    assert rb["accuracy"] == 1.0 and rb["loss"] > 0


def test_threshold_never_reached_is_null(spark):
    from classbench.operators import importance
    df = spark.createDataFrame([("a", 0.5), ("b", 0.3), ("c", 0.2)], "feature string, importance double")
    got = {r["threshold"]: r["n_items"] for r in importance.needed_for(df, (0.8, 1.5)).collect()}
    assert got == {0.8: 2, 1.5: None}
    top = [r["feature"] for r in importance.top_k(df, 10).collect()]
    assert top == ["a", "b", "c"]  # fewer than k rows is fine
