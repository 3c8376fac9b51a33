"""Reports: small tables built from metric tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from classbench.functions.scalar import fmt_fixed
from classbench.operators.compare import METRICS, fold_summary
from classbench.sources.io import report_sink


def model_summary(metrics_long: DataFrame, info: dict, path: str | None = None) -> DataFrame:
    """One row (model facts + test metrics as '%.4f' text), transposed to
    (field, Value) and, with ``path``, written as CSV (S5)."""
    wide = metrics_long.groupBy().pivot("metric", list(METRICS)).agg(F.first("value"))
    cols = [F.lit(str(v)).alias(k) for k, v in info.items()]
    cols += [fmt_fixed(F.col(m), 4).alias(m) for m in METRICS]
    one = wide.select(*cols)
    if path is None:
        from classbench.sources.io import transpose_one_row
        return transpose_one_row(one)
    return report_sink(one, path)


def detailed_report(test_long: DataFrame, fold_long: DataFrame,
                    best_by=("f1", "roc_auc", "accuracy")) -> DataFrame:
    """R2: (section, model, metric, value) rows: test metrics per model, CV mean
    and std per model and metric, and the best model by F1, ROC-AUC and accuracy
    (first model name on ties)."""
    test = test_long.select(F.lit("test").alias("section"), "model", "metric", "value")
    fs = fold_summary(fold_long, value="value")
    mean = fs.select(F.lit("cv_mean").alias("section"), "model", "metric", F.col("mean").alias("value"))
    std = fs.select(F.lit("cv_std").alias("section"), "model", "metric", F.col("std").alias("value"))
    best = [test_long.where(F.col("metric") == m).orderBy(F.desc("value"), F.asc("model")).limit(1)
            .select(F.lit(f"best_{m}").alias("section"), "model", "metric", "value") for m in best_by]
    return reduce(lambda a, b: a.unionByName(b), [test, mean, std, *best])
