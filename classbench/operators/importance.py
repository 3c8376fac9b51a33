"""Importance-style tables.

These run on a small (item, weight) table: one row per feature.  Windows
without partition keys are allowed here because the table is bounded by the
feature count, never by rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from classbench.operators.profile import histogram


def importance_table(spark, names: list[str], weights) -> DataFrame:
    """(feature, importance) from a model's importance vector."""
    vals = weights.toArray().tolist() if hasattr(weights, "toArray") else list(weights)
    schema = StructType([StructField("feature", StringType()), StructField("importance", DoubleType())])
    return spark.createDataFrame(list(zip(names, [float(v) for v in vals])), schema)


def ranked(df: DataFrame, item: str = "feature", weight: str = "importance") -> DataFrame:
    """K1 + K5: descending order (ties by name), position and cumulative weight."""
    w = Window.orderBy(F.desc(weight), F.asc(item))
    cum = w.rowsBetween(Window.unboundedPreceding, 0)
    return df.select(item, weight, F.row_number().over(w).alias("position"),
                     F.sum(weight).over(cum).alias("cumulative")).orderBy("position")


def top_k(df: DataFrame, k: int = 10, item: str = "feature", weight: str = "importance") -> DataFrame:
    """K2: the ``k`` largest weights (fewer if the table is smaller)."""
    return df.orderBy(F.desc(weight), F.asc(item)).limit(k)


def needed_for(df: DataFrame, thresholds=(0.8, 0.9), item: str = "feature",
               weight: str = "importance") -> DataFrame:
    """First position whose cumulative share reaches each threshold (null if never)."""
    r = ranked(df, item, weight)
    total = F.sum(weight).over(Window.partitionBy())
    share = r.select("position", (F.col("cumulative") / total).alias("share"))
    return share.agg(*[F.min(F.when(F.col("share") >= F.lit(t), F.col("position"))).alias(f"t{i}")
                       for i, t in enumerate(thresholds)]).select(
        F.explode(F.array(*[F.struct(F.lit(t).alias("threshold"), F.col(f"t{i}").alias("n_items"))
                            for i, t in enumerate(thresholds)])).alias("x")).select("x.*")


def importance_histogram(df: DataFrame, weight: str = "importance", bins: int = 20) -> DataFrame:
    """Histogram of the weights."""
    return histogram(df, weight, bins)
