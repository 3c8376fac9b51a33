"""ROC and precision-recall curves, ROC-AUC.

1. Collapse ties: one row per (group, distinct score) with positive and
   negative counts (partial aggregation, so a hot score costs nothing).
2. That table is written (it is reused; its counts take little room there) and bucketed by a monotone
   function of the score (approximate cut points; exactness does not depend
   on them).
3. Per-bucket totals get prefix sums over higher buckets; they are joined
   back and a window
   inside each (group, bucket) finishes the running sums.

No window ever spans a whole group of rows, so one model or one class with a
third of the data is still spread over many tasks.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from classbench.operators.rank import value_bucket
from classbench.session import written

ROWS_PER_BUCKET = 1 << 20


def counted(condition: Column, rows: str | None = None) -> Column:
    """Number of rows where ``condition`` holds; ``rows`` names a column with the number that a row stands for."""
    return F.count_if(condition) if rows is None else F.coalesce(F.sum(F.when(condition, F.col(rows))), F.lit(0).cast("long"))


def score_table(df: DataFrame, label: str, score: str, groups: list[str] = (),
                positive=1, extra=(), rows: str | None = None) -> DataFrame:
    """(groups..., score, pos, neg): one row per distinct score (null among them), and ``extra`` aggregates."""
    y = F.col(label) == F.lit(positive)
    return (df.groupBy(*groups, F.col(score).cast("double").alias("score"))
            .agg(counted(y, rows).alias("pos"), counted(~y, rows).alias("neg"), *extra))


def running_counts(df: DataFrame, label: str, score: str, groups: list[str] = (),
                   positive=1, rows_per_bucket: int = ROWS_PER_BUCKET, with_table: bool = False, extra=(), rows: str | None = None):
    """(groups..., score, pos, neg, tp, fp, P, N): tp/fp = rows scored >= score; null scores are in no row.

    With ``with_table`` also returns the written distinct-score table (null
    scores included), which carries the ``extra`` aggregates.
    """
    groups = list(groups)
    table = written(score_table(df, label, score, groups, positive, extra, rows), "scores")
    st = table.where(F.col("score").isNotNull())
    m = st.count()
    nb = max(1, math.ceil(m / rows_per_bucket))
    d, b = value_bucket(st, "score", nb)
    d = d.withColumn("_b", b)
    tot = d.groupBy(*groups, "_b").agg(F.sum("pos").alias("_bp"), F.sum("neg").alias("_bn"))
    higher = Window.partitionBy(*groups).orderBy(F.desc("_b")).rowsBetween(
        Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*groups)
    offs = tot.select(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(groups)],
                      F.col("_b").alias("_ob"),
                      F.coalesce(F.sum("_bp").over(higher), F.lit(0)).alias("_op"),
                      F.coalesce(F.sum("_bn").over(higher), F.lit(0)).alias("_on"),
                      F.sum("_bp").over(whole).alias("P"), F.sum("_bn").over(whole).alias("N"))
    cond = F.col("_b") == F.col("_ob")
    for i, g in enumerate(groups):
        cond = cond & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    w = Window.partitionBy(*groups, "_b").orderBy(F.desc("score")).rowsBetween(
        Window.unboundedPreceding, 0)
    j = d.join(offs, cond)
    rc = j.select(*groups, "score", "pos", "neg",
                  (F.col("_op") + F.sum("pos").over(w)).cast("long").alias("tp"),
                  (F.col("_on") + F.sum("neg").over(w)).cast("long").alias("fp"),
                  F.col("P").cast("long").alias("P"), F.col("N").cast("long").alias("N"))
    return (rc, table) if with_table else rc


def roc_curve(df: DataFrame, label: str = "label", score: str = "score",
              groups: list[str] = (), positive=1, **kw) -> DataFrame:
    """V7/V9: (groups..., threshold, fpr, tpr), one row per distinct score plus
    the start point (threshold +inf, 0, 0).  No intermediate point is dropped."""
    groups = list(groups)
    rc, st = running_counts(df, label, score, groups, positive, with_table=True, **kw)
    pts = rc.select(*groups, F.col("score").alias("threshold"),
                    (F.col("fp") / F.nullif(F.col("N"), F.lit(0))).alias("fpr"),
                    (F.col("tp") / F.nullif(F.col("P"), F.lit(0))).alias("tpr"))
    start = st.where(F.col("score").isNotNull()).select(*groups).distinct().select(
        *groups, F.lit(math.inf).alias("threshold"), F.lit(0.0).alias("fpr"),
        F.lit(0.0).alias("tpr"))
    return pts.unionByName(start)


def pr_curve(df: DataFrame, label: str = "label", score: str = "score",
             groups: list[str] = (), positive=1, **kw) -> DataFrame:
    """V8: (groups..., threshold, precision, recall) per distinct score, plus the
    end point (null threshold, precision 1, recall 0)."""
    groups = list(groups)
    rc, st = running_counts(df, label, score, groups, positive, with_table=True, **kw)
    prec = F.coalesce(F.col("tp") / F.nullif(F.col("tp") + F.col("fp"), F.lit(0)), F.lit(0.0))
    rec = F.when(F.col("P") == 0, F.lit(1.0)).otherwise(F.col("tp") / F.col("P"))
    pts = rc.select(*groups, F.col("score").alias("threshold"), prec.alias("precision"),
                    rec.alias("recall"))
    end = st.where(F.col("score").isNotNull()).select(*groups).distinct().select(
        *groups, F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"),
        F.lit(0.0).alias("recall"))
    return pts.unionByName(end)


def roc_auc(df: DataFrame, label: str = "label", score: str = "score",
            groups: list[str] = (), positive=1, **kw) -> DataFrame:
    """V6: ROC-AUC with ties (trapezoid over the ROC points), per group.

    Sum over distinct scores of neg * (tp_before + pos / 2) / (P * N); null
    when a group has only one class.
    """
    return auc_of(running_counts(df, label, score, list(groups), positive, **kw), list(groups))


def auc_of(rc: DataFrame, groups: list[str]) -> DataFrame:
    """ROC-AUC per group from the table of :func:`running_counts`."""
    term = F.col("neg") * (F.col("tp") - F.col("pos") / 2.0)
    return rc.groupBy(*groups).agg(
        (F.sum(term) / F.nullif(F.max("P") * F.max("N"), F.lit(0))).alias("roc_auc"))
