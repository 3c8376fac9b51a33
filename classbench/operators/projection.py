"""2-D projection and decision grid."""

from __future__ import annotations

import math

import numpy as np
from pyspark.ml.feature import PCA, StandardScaler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_MESH_POINTS = 16_000_000


def mesh_grid(df: DataFrame, xcol: str, ycol: str, step: float = 0.02, margin: float = 1.0,
              max_points: int = MAX_MESH_POINTS) -> DataFrame:
    """(ix, iy, x, y) over [min - margin, max + margin) of two columns.

    Size depends on the value range and step, not on the row count; the
    grid is generated by ``spark.range`` on the executors.  A grid above
    ``max_points`` is refused (choose a larger step) rather than truncated.
    """
    r = df.agg(F.min(xcol).alias("x0"), F.max(xcol).alias("x1"),
               F.min(ycol).alias("y0"), F.max(ycol).alias("y1")).first()
    x0, x1 = r["x0"] - margin, r["x1"] + margin
    y0, y1 = r["y0"] - margin, r["y1"] + margin
    nx, ny = int(math.ceil((x1 - x0) / step)), int(math.ceil((y1 - y0) / step))
    if nx * ny > max_points:
        raise ValueError(f"mesh of {nx}x{ny} points exceeds {max_points}; use a larger step")
    g = df.sparkSession.range(nx * ny)
    return g.select((F.col("id") % nx).alias("ix"), (F.col("id") / nx).cast("long").alias("iy")).select(
        "ix", "iy", (F.lit(x0) + F.col("ix") * F.lit(step)).alias("x"),
        (F.lit(y0) + F.col("iy") * F.lit(step)).alias("y"))


def pca_2d(df: DataFrame, features: str = "features", k: int = 2, out: str = "pc"):
    """Centred PCA to ``k`` components.

    Spark's PCA does not centre on transform, so vectors are centred first
    (StandardScaler with mean only).  Each component's sign makes its
    largest absolute loading positive.  Returns (frame with pc_1..pc_k,
    explained-variance ratios, total ratio).  The covariance is a d x d
    Gramian tree-aggregated by Spark (bounded by the feature count).
    """
    centred = StandardScaler(withMean=True, withStd=False, inputCol=features,
                             outputCol="_centred").fit(df).transform(df)
    model = PCA(k=k, inputCol="_centred", outputCol="_pcs").fit(centred)
    pcs = model.pc.toArray()
    signs = [1.0 if pcs[np.argmax(np.abs(pcs[:, j])), j] >= 0 else -1.0 for j in range(k)]
    arr = vector_to_array(F.col("_pcs"))
    cols = [(arr[j] * F.lit(signs[j])).alias(f"{out}_{j + 1}") for j in range(k)]
    projected = model.transform(centred).select(*df.columns, *cols)
    ratio = [float(v) for v in model.explainedVariance.toArray()]
    return projected, ratio, float(sum(ratio))


def decision_surface(model, train_2d: DataFrame, xcol: str, ycol: str, step: float = 0.02,
                     margin: float = 1.0) -> DataFrame:
    """A mesh over two features scored by a model fitted on those two features.

    Output (ix, iy, x, y, prediction, score); scoring runs on the executors.
    """
    from pyspark.ml.feature import VectorAssembler

    mesh = mesh_grid(train_2d, xcol, ycol, step, margin)
    feats = VectorAssembler(inputCols=["x", "y"], outputCol="features").transform(mesh)
    scored = model.transform(feats)
    return scored.select("ix", "iy", "x", "y", F.col("prediction").cast("int").alias("prediction"), "score")
