"""Prediction inspection."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from classbench.functions.scalar import confidence_binary, correct_flag
from classbench.operators.profile import histogram


def with_confidence(df: DataFrame, label: str = "label", prediction: str = "prediction",
                    prob: str = "score", multiclass: bool = False) -> DataFrame:
    """P14 + P15: adds ``confidence`` and ``correct`` (0/1)."""
    conf = F.array_max(F.col(prob)) if multiclass else confidence_binary(prob)
    return df.withColumn("confidence", conf.cast("double")).withColumn(
        "correct", correct_flag(label, prediction))


def extremes(df: DataFrame, value: str = "confidence", id_col: str = "id", k: int = 5,
             cols: list[str] = ("label", "prediction")) -> DataFrame:
    """K3: the ``k`` least and ``k`` most confident rows (ties by id).

    Two bounded top-k (TakeOrderedAndProject) results, unioned.
    """
    keep = [id_col, *cols, value]
    low = df.orderBy(F.asc(value), F.asc(id_col)).limit(k).select(F.lit("least").alias("kind"), *keep)
    high = df.orderBy(F.desc(value), F.asc(id_col)).limit(k).select(F.lit("most").alias("kind"), *keep)
    return low.unionByName(high)


def first_per_class(df: DataFrame, label: str = "label", id_col: str = "id", k: int = 2,
                    max_classes: int = 10) -> DataFrame:
    """K4: first ``k`` rows of each of the first ``max_classes`` classes by id.

    ``row_number() <= k`` is planned as a WindowGroupLimit: each task keeps at
    most k rows per class before the shuffle, so a hot class costs nothing.
    """
    classes = [r[0] for r in df.select(label).distinct().orderBy(label).limit(max_classes).collect()]
    w = Window.partitionBy(label).orderBy(id_col)
    return (df.where(F.col(label).isin(classes))
            .withColumn("sample", F.row_number().over(w)).where(F.col("sample") <= k))


def probability_distribution(df: DataFrame, label: str = "label", prob: str = "score",
                             bins: int = 30) -> DataFrame:
    """Histogram of the positive-class probability per true class, shared edges."""
    return histogram(df, prob, bins, group=label)


def confidence_distribution(df: DataFrame, bins: int = 20) -> DataFrame:
    """Histogram of confidence split by correct / incorrect."""
    return histogram(df, "confidence", bins, group="correct")
