"""Classification metrics.

Everything is one aggregate over (label, prediction[, score]) with map-side
partial aggregation; results are bounded by the number of classes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _ratio(a: Column, b: Column) -> Column:
    """a / b, 0 when b is 0 (sklearn's zero_division=0 behaviour)."""
    return F.coalesce(a / F.nullif(b, F.lit(0)), F.lit(0.0))


def _class_type(df: DataFrame, label: str, prediction: str):
    """Common type of both class columns."""
    return df.select(F.coalesce(F.col(label), F.col(prediction))).schema[0].dataType


def class_list(df: DataFrame, label: str, prediction: str) -> list:
    """Sorted distinct classes seen as label or prediction (bounded by classes)."""
    rows = (df.select(F.col(label).alias("c")).union(df.select(F.col(prediction).alias("c")))
            .where(F.col("c").isNotNull()).distinct().collect())
    return sorted(r["c"] for r in rows)


def confusion_matrix(df: DataFrame, label: str = "label", prediction: str = "prediction",
                     classes: list | None = None) -> DataFrame:
    """V1: (actual, predicted, count) for every pair of classes, zeros kept.

    The pairs are the result itself; they are made in as many tasks as Spark
    gives a range over the classes.  Without any class the result is empty.
    """
    if classes is None:
        classes = class_list(df, label, prediction)
    kind = _class_type(df, label, prediction)
    counts = df.groupBy(F.col(label).cast(kind).alias("actual"), F.col(prediction).cast(kind).alias("predicted")).agg(
        F.count(F.lit(1)).alias("n"))
    if not classes:
        return counts.where(F.lit(False)).withColumnRenamed("n", "count")
    lits = F.array(*[F.lit(c).cast(kind) for c in classes])
    grid = (df.sparkSession.range(len(classes)).select(F.get(lits, F.col("id").cast("int")).alias("actual"))
            .select("actual", F.explode(lits).alias("predicted")))
    return (grid.join(counts, ["actual", "predicted"], "left")
            .select("actual", "predicted", F.coalesce("n", F.lit(0)).cast("long").alias("count")))


def binary_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction",
                   positive=1) -> DataFrame:
    """V2+V3: accuracy and precision, recall, F1 of the positive class, one pass."""
    y = F.col(label) == F.lit(positive)
    p = F.col(prediction) == F.lit(positive)
    agg = df.agg(F.count(F.lit(1)).alias("n"),
                 F.count_if(F.col(label) == F.col(prediction)).alias("correct"),
                 F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"),
                 F.count_if(y & ~p).alias("fn"))
    prec = _ratio(F.col("tp"), F.col("tp") + F.col("fp"))
    rec = _ratio(F.col("tp"), F.col("tp") + F.col("fn"))
    return agg.select(
        _ratio(F.col("correct"), F.col("n")).alias("accuracy"), prec.alias("precision"),
        rec.alias("recall"),
        _ratio(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")).alias("f1"))


def _class_counts(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """(class, tp, predicted, support) in one grouped aggregate, linear in rows and classes.

    A row adds to the support of its label and to the count of its prediction;
    where either is null it adds to neither, but names its class.
    """
    kind = _class_type(df, label, prediction)
    y, p = F.col(label).cast(kind), F.col(prediction).cast(kind)
    ends = F.array(
        F.struct(y.alias("class"), p.isNotNull().cast("long").alias("support"), F.lit(0).cast("long").alias("predicted"),
                 F.coalesce((y == p).cast("long"), F.lit(0).cast("long")).alias("tp")),
        F.struct(p.alias("class"), F.lit(0).cast("long").alias("support"), y.isNotNull().cast("long").alias("predicted"),
                 F.lit(0).cast("long").alias("tp")))
    return (df.select(F.explode(ends).alias("e")).select("e.*").where(F.col("class").isNotNull())
            .groupBy("class").agg(*[F.sum(c).alias(c) for c in ("tp", "predicted", "support")]))


def per_class(df: DataFrame, label: str = "label", prediction: str = "prediction",
              with_tp: bool = False) -> DataFrame:
    """(class, precision, recall, f1, support) of every class seen as label or prediction."""
    j = _class_counts(df, label, prediction)
    prec = _ratio(F.col("tp"), F.col("predicted"))
    rec = _ratio(F.col("tp"), F.col("support"))
    f1 = _ratio(2 * F.col("tp"), F.col("predicted") + F.col("support"))
    extra = [F.col("tp")] if with_tp else []
    return j.select("class", prec.alias("precision"), rec.alias("recall"), f1.alias("f1"),
                    F.col("support").cast("long").alias("support"), *extra)


def weighted_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """V4: support-weighted precision, recall and F1."""
    pc = per_class(df, label, prediction)
    tot = F.sum("support")
    return pc.agg(
        _ratio(F.sum(F.col("precision") * F.col("support")), tot).alias("precision"),
        _ratio(F.sum(F.col("recall") * F.col("support")), tot).alias("recall"),
        _ratio(F.sum(F.col("f1") * F.col("support")), tot).alias("f1"))


def classification_report(df: DataFrame, label: str = "label", prediction: str = "prediction",
                          names: dict | None = None) -> DataFrame:
    """V5: one row per class, then accuracy, macro avg and weighted avg.

    Columns: row_order, row, precision, recall, f1, support.  The accuracy row
    has null precision/recall and f1 = accuracy, as in the usual text report.
    """
    pc = per_class(df, label, prediction, with_tp=True)
    cls = F.col("class")
    if names:
        m = F.create_map(*[x for k, v in names.items() for x in (F.lit(k), F.lit(v))])
        row = F.coalesce(m[cls], cls.cast("string"))
    else:
        row = cls.cast("string")
    # the per-class table is bounded by the class count, so a global window is fine
    classes = pc.select(F.dense_rank().over(Window.orderBy(cls)).cast("int").alias("row_order"),
        row.alias("row"), "precision", "recall", "f1", "support")
    tot = F.sum("support")
    summary = pc.agg(
        tot.alias("n"), F.sum("tp").alias("hit"),
        F.avg("precision").alias("mp"), F.avg("recall").alias("mr"), F.avg("f1").alias("mf"),
        _ratio(F.sum(F.col("precision") * F.col("support")), tot).alias("wp"),
        _ratio(F.sum(F.col("recall") * F.col("support")), tot).alias("wr"),
        _ratio(F.sum(F.col("f1") * F.col("support")), tot).alias("wf"))
    none = F.lit(None).cast("double")

    def line(order, name, precision, recall, f1):
        return F.struct(F.lit(1_000_000 + order).cast("int").alias("row_order"), F.lit(name).alias("row"),
                        precision.alias("precision"), recall.alias("recall"), f1.alias("f1"),
                        F.col("n").cast("long").alias("support"))

    lines = F.inline(F.array(
        line(1, "accuracy", none, none, _ratio(F.col("hit"), F.col("n"))),
        line(2, "macro avg", F.col("mp"), F.col("mr"), F.col("mf")),
        line(3, "weighted avg", F.col("wp"), F.col("wr"), F.col("wf"))))
    return classes.unionByName(summary.select(lines))


def loss_accuracy(df: DataFrame, label: str, probs: str, eps: float = 1e-7) -> DataFrame:
    """Mean cross-entropy and accuracy for an array of class probabilities.

    p[label] is clipped to [eps, 1 - eps] before the log; accuracy compares
    the first-wins argmax with the label.
    """
    p = F.col(probs)
    p_true = F.element_at(p, F.col(label) + 1).cast("double")
    clipped = F.least(F.greatest(p_true, F.lit(eps)), F.lit(1.0 - eps))
    pred = F.array_position(p, F.array_max(p)) - 1
    return df.agg(F.avg(-F.ln(clipped)).alias("loss"),
                  F.avg((pred == F.col(label)).cast("double")).alias("accuracy"))


def binary_loss_accuracy(df: DataFrame, label: str, prob: str, eps: float = 1e-7) -> DataFrame:
    """V10, binary head: mean binary cross-entropy and accuracy at p > 0.5."""
    p = F.least(F.greatest(F.col(prob).cast("double"), F.lit(eps)), F.lit(1.0 - eps))
    y = F.col(label).cast("double")
    bce = -(y * F.ln(p) + (1 - y) * F.ln(1 - p))
    return df.agg(F.avg(bce).alias("loss"),
                  F.avg(((F.col(prob) > 0.5).cast("int") == F.col(label)).cast("double")).alias("accuracy"))


def grouped_binary_metrics(df: DataFrame, groups: list[str], label: str = "label",
                           prediction: str = "prediction", score: str | None = None,
                           positive=1, rows: str | None = None) -> DataFrame:
    """Long table (groups..., metric, value) of accuracy, precision, recall, F1
    and, with ``score``, ROC-AUC, per group (e.g. model, fold); ``df`` is read once.
    ``rows`` names a column with the number of rows that a row stands for."""
    from classbench.operators.curves import auc_of, counted, running_counts

    y = F.col(label) == F.lit(positive)
    p = F.col(prediction) == F.lit(positive)
    counts = {"n": counted(F.lit(True), rows), "ok": counted(F.col(label) == F.col(prediction), rows), "tp": counted(y & p, rows),
              "fp": counted(~y & p, rows), "fn": counted(y & ~p, rows)}
    if score is None:
        agg = df.groupBy(*groups).agg(*[c.alias(k) for k, c in counts.items()])
    else:  # counts per distinct score: one pass over the rows feeds the counts and the area
        running, table = running_counts(df, label, score, groups, positive, with_table=True, rows=rows,
                                        extra=[c.alias(f"_{k}") for k, c in counts.items()])
        agg = table.groupBy(*groups).agg(*[F.sum(f"_{k}").alias(k) for k in counts])
    wide = agg.select(
        *groups, _ratio(F.col("ok"), F.col("n")).alias("accuracy"),
        _ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        _ratio(F.col("tp"), F.col("tp") + F.col("fn")).alias("recall"),
        _ratio(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")).alias("f1"))
    long = wide.unpivot(list(groups), ["accuracy", "precision", "recall", "f1"], "metric", "value")
    if score is None:
        return long
    auc = auc_of(running, list(groups)).select(
        *groups, F.lit("roc_auc").alias("metric"), F.col("roc_auc").alias("value"))
    return long.unionByName(auc)
