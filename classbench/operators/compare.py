"""Fold summaries, model comparison and small-table reshaping."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

METRICS = ("accuracy", "precision", "recall", "f1", "roc_auc")


def fold_summary(scores: DataFrame, groups=("model", "metric"), value: str = "score") -> DataFrame:
    """T5: mean, population std, min, max and mean +/- 2 std per (model, metric)."""
    g = scores.groupBy(*groups).agg(F.avg(value).alias("mean"), F.stddev_pop(value).alias("std"),
                                    F.min(value).alias("min"), F.max(value).alias("max"),
                                    F.count(value).alias("folds"))
    return g.withColumn("lo", F.col("mean") - 2 * F.col("std")).withColumn(
        "hi", F.col("mean") + 2 * F.col("std"))


def comparison_table(long: DataFrame, metrics=METRICS, key: str = "model",
                     metric: str = "metric", value: str = "value") -> DataFrame:
    """(model, metric, value) rows pivoted to one row per model.

    The metric list is given, so the pivot needs no extra distinct pass.
    """
    return long.groupBy(key).pivot(metric, list(metrics)).agg(F.first(value))


def best_row(df: DataFrame, by: str, order: str) -> DataFrame:
    """K7: the row with the largest ``by``; ties keep the first by ``order``."""
    return df.orderBy(F.desc(by), F.asc(order)).limit(1)


def running_best(history: DataFrame, col: str = "val_accuracy", step: str = "epoch") -> DataFrame:
    """K8: best value over epochs and the value of the last epoch."""
    return history.agg(F.max(col).alias("best"), F.max_by(col, step).alias("last"),
                       F.min_by(step, F.struct(-F.col(col), F.col(step))).alias("best_epoch"))


def union_all(*parts: DataFrame) -> DataFrame:
    """Union by column name."""
    return reduce(lambda a, b: a.unionByName(b), parts)


def transpose(df: DataFrame, key: str, columns: list[str], keys: list) -> DataFrame:
    """Rows become columns for a small table: (field, <key value>...).

    ``keys`` lists the row keys (the new columns), so the pivot is planned
    without a distinct pass.  Values are compared as double.
    """
    long = df.select(key, *[F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        key, columns, "field", "v")
    return long.groupBy("field").pivot(key, list(keys)).agg(F.first("v"))
