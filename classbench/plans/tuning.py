"""Tuning and resampling.

Folds are precomputed (exact stratified, L3) and stored in a fold column, so
every fit sees the same rows in every run.  Each fit is a distributed Spark
job; grids run ``parallelism`` fits at a time from driver threads.
"""

from __future__ import annotations

import itertools
import time

from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from classbench.models.forest_nodes import GrownForest
from classbench.operators.metrics import grouped_binary_metrics
from classbench.operators.split import hash_fold_ranks
from classbench.session import written

# The named grids of the reference workflows.
FOREST_GRID = {
    "n_estimators": [100, 200, 300],
    "max_depth": [10, 20, 30, None],
    "min_samples_split": [2, 5, 10],
    "min_samples_leaf": [1, 2, 4],
    "max_features": ["sqrt", "log2"],
}
FOREST_APP_DEFAULT = {
    "n_estimators": [100, 200],
    "max_depth": [20, None],
    "min_samples_split": [2, 5],
    "min_samples_leaf": [1, 2],
    "max_features": ["sqrt"],
}
SVM_GRIDS = {
    "linear": {"C": [0.1, 1, 10, 100]},
    "rbf": {"C": [0.1, 1, 10, 100], "gamma": ["scale", "auto", 0.001, 0.01, 0.1, 1]},
    "poly": {"C": [0.1, 1, 10], "degree": [2, 3, 4], "gamma": ["scale", "auto"]},
    "sigmoid": {"C": [0.1, 1, 10], "gamma": ["scale", "auto"]},
}
LEARNING_FRACTIONS = [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]
VALIDATION_RANGES = {"n_estimators": [50, 100, 150, 200, 250, 300],
                     "max_depth": [5, 10, 15, 20, 25, 30]}


def grid_points(grid: dict) -> list[dict]:
    """All combinations of a grid, in key order."""
    keys = list(grid)
    return [dict(zip(keys, vals)) for vals in itertools.product(*[grid[k] for k in keys])]


def grid_sizes() -> dict[str, int]:
    """Number of points of every named grid."""
    out = {"forest": len(grid_points(FOREST_GRID)), "forest_app_default": len(grid_points(FOREST_APP_DEFAULT))}
    out.update({f"svm_{k}": len(grid_points(g)) for k, g in SVM_GRIDS.items()})
    return out


def f1_positive(label: str = "label", prediction: str = "prediction") -> MulticlassClassificationEvaluator:
    """F1 of class 1 (the reference's 'f1'); Spark's own 'f1' is weighted (Q7)."""
    return MulticlassClassificationEvaluator(labelCol=label, predictionCol=prediction,
                                             metricName="fMeasureByLabel", metricLabel=1.0)


def grid_search(estimator, param_maps: list, train: DataFrame, k: int, fold_col: str = "fold",
                evaluator=None, parallelism: int = 2, seed: int = 42):
    """T1 + T3: CrossValidator over precomputed folds; refits the best on all rows.

    Returns (best model, table (point, params, mean_f1)) with every grid point kept.
    """
    ev = evaluator or f1_positive(estimator.getLabelCol())
    cv = CrossValidator(estimator=estimator, estimatorParamMaps=param_maps, evaluator=ev,
                        numFolds=k, foldCol=fold_col, parallelism=parallelism, seed=seed)
    model = cv.fit(train)
    spark = train.sparkSession
    rows = []
    for i, (pm, m) in enumerate(zip(param_maps, model.avgMetrics)):
        desc = ", ".join(f"{p.name}={v}" for p, v in sorted(pm.items(), key=lambda kv: kv[0].name))
        rows.append((i, desc, float(m)))
    schema = StructType([StructField("point", IntegerType()), StructField("params", StringType()),
                         StructField("mean_f1", DoubleType())])
    return model.bestModel, spark.createDataFrame(rows, schema)


def param_grid(estimator, grid: dict) -> list:
    """Spark ParamMaps from a {param name: values} dict."""
    b = ParamGridBuilder()
    for name, values in grid.items():
        b = b.addGrid(estimator.getParam(name), values)
    return b.build()


def forest_param_maps(estimator, grid: dict) -> list:
    """ParamMaps of a forest grid in the reference's names.

    ``min_samples_split`` has no Spark form; it is approximated as in ``forest``.
    """
    from classbench.models.forest import forest

    maps = []
    for p in grid_points(grid):
        made = forest(p.get("n_estimators", 100), p.get("max_depth"), p.get("min_samples_split", 2),
                      p.get("min_samples_leaf", 1), p.get("max_features", "sqrt"), approximate=True)
        maps.append({estimator.getParam(n): made.getOrDefault(n)
                     for n in ("numTrees", "maxDepth", "minInstancesPerNode", "featureSubsetStrategy")})
    return maps


def fitted(estimator, df: DataFrame, score_fn=None):
    """What ``score_fn`` scores by: a forest's node table, without loading a model from it, or else the fitted model."""
    from classbench.models.forest import CellForestClassifier, score

    return estimator.grow(df) if score_fn is score and isinstance(estimator, CellForestClassifier) else estimator.fit(df)


def _forest_of(make_estimator, score_fn):
    """The estimator, if it is a forest that is grown and scored on counted cells; else nothing."""
    from classbench.models.forest import CellForestClassifier, score

    est = make_estimator() if score_fn is score else None
    return est if isinstance(est, CellForestClassifier) else None


def _family(est) -> tuple:
    """What forests must share to be prefixes and cuts of one."""
    return tuple(sorted((p.name, str(v)) for p, v in est.extractParamMap().items() if p.name not in ("numTrees", "maxDepth")))


def _whole(est) -> tuple[int, int, int]:
    """The variant of a forest's cells that is the forest itself."""
    return est.getNumTrees(), est.getMaxDepth(), 2


def cv_scores(make_estimator, df: DataFrame, k: int, fold_col: str = "fold", label: str = "label",
              model_name: str = "model", score_fn=None, parallelism: int = 2) -> DataFrame:
    """T4: fit once per fold, score the held-out fold, then all five metrics
    (accuracy, precision, recall, F1, ROC-AUC) from one grouped aggregate.
    Fold fits run ``parallelism`` at a time from driver threads.

    Output (model, fold, metric, value, train_seconds).
    """
    from concurrent.futures import ThreadPoolExecutor

    if (est := _forest_of(make_estimator, score_fn)) is not None:
        return _forest_cv_scores(make_estimator, est, df, k, fold_col, model_name, parallelism)

    def one(f):
        t0 = time.time()
        model = fitted(make_estimator(), df.where(F.col(fold_col) != f), score_fn)
        secs = time.time() - t0
        held = df.where(F.col(fold_col) == f)
        scored = score_fn(model, held) if score_fn else model.transform(held)
        return scored.select(F.lit(model_name).alias("model"), F.col(fold_col).alias("fold"),
                             F.col(label).alias("label"),
                             F.col("prediction").cast("int").alias("prediction"),
                             F.col("score"), F.lit(secs).alias("train_seconds"))

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        parts = list(pool.map(one, range(k)))
    allp = parts[0]
    for p in parts[1:]:
        allp = allp.unionByName(p)
    secs = allp.groupBy("model", "fold").agg(F.first("train_seconds").alias("train_seconds"))
    return grouped_binary_metrics(allp, ["model", "fold"], "label", "prediction", "score").join(
        secs, ["model", "fold"])


def _forest_cv_scores(make_estimator, est, df: DataFrame, k: int, fold_col: str, model_name: str, parallelism: int) -> DataFrame:
    """:func:`cv_scores` of forests, whose folds are scored by their counted cells."""
    from concurrent.futures import ThreadPoolExecutor

    from classbench.models.forest_parts import held_scores, part_cells, plain_rows

    rows = plain_rows(df.where(F.col(fold_col).isNotNull()), est, F.col(fold_col).alias("fold")).persist()
    kind = rows.schema["fold"].dataType

    def one(f):
        made, t0 = make_estimator(), time.time()
        parts = part_cells(rows, F.col("fold") == f, made.getMaxBins())
        trees = written(parts.grow(made), "trees")
        secs = time.time() - t0
        scores = held_scores(parts, trees, made.getNumTrees())
        return secs, written(scores.select(F.lit(model_name).alias("model"), F.lit(f).cast(kind).alias("fold"), "*"), "scores")

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        made = list(pool.map(one, range(k)))
    rows.unpersist()
    scored = made[0][1]
    for _, part in made[1:]:
        scored = scored.unionByName(part)
    secs = df.sparkSession.createDataFrame([(model_name, f, s) for f, (s, _) in enumerate(made)], StructType([
        StructField("model", StringType()), StructField("fold", LongType()), StructField("train_seconds", DoubleType())])).withColumn("fold", F.col("fold").cast(kind))
    return grouped_binary_metrics(scored, ["model", "fold"], "label", "prediction", "score", rows="rows").join(secs, ["model", "fold"])


def _metric_fn(metric: str, label: str):
    """Scalar metric (accuracy or F1 of class 1) of the parts of a scored frame where ``held`` is false and true, from one aggregate; 0 for an empty part."""
    def ev(scored: DataFrame, held: str) -> dict[bool, float]:
        d = scored.withColumn("prediction", F.col("prediction").cast("int")).withColumn(
            label, F.col(label).cast("int"))
        rows = grouped_binary_metrics(d, [held], label, "prediction").where(F.col("metric") == metric).collect()
        return {False: 0.0, True: 0.0} | {r[held]: float(r["value"]) for r in rows}
    return ev


def _let_go(model) -> None:
    if isinstance(model, GrownForest):
        model.close()


def learning_curve(make_estimator, df: DataFrame, k: int, id_col: str = "id", label: str = "label",
                   fold_col: str = "fold", fractions=LEARNING_FRACTIONS, metric: str = "accuracy",
                   score_fn=None, seed: int = 42, parallelism: int = 2) -> DataFrame:
    """For each fold, nested training prefixes of exact size floor(f * n_train)
    in md5 order (L6), one fit per (fraction, fold); train and validation score.
    One ranking of the table serves all folds; fits run ``parallelism`` at a
    time from driver threads.

    ``metric`` defaults to accuracy (the reference passes no scoring, Q3).
    Output (fraction, n_train, fold, train_score, val_score).
    """
    from concurrent.futures import ThreadPoolExecutor

    from classbench.models.forest_parts import metric_of, part_cells, part_counts, plain_rows

    spark, est = df.sparkSession, _forest_of(make_estimator, score_fn)
    ev = _metric_fn(metric, label)
    ranked = hash_fold_ranks(df, id_col, fold_col, k, seed, "curve|")
    ranked = written(ranked, "curve") if est is None else written(plain_rows(ranked, est, "_ranks"), "curve")
    sizes = ranked.agg(*[F.count(F.col("_ranks")[f]) for f in range(k)]).first()

    def one(point):
        f, frac = point
        size, rank = int(frac * sizes[f]), F.col("_ranks")[f]
        rows = ranked.where(rank.isNull() | (rank <= size))
        if est is not None:
            made = make_estimator()
            parts = part_cells(rows, rank.isNull(), made.getMaxBins())
            counts = part_counts(parts, parts.grow(made), [_whole(made)])
            return float(frac), size, f, *(metric_of(counts[_whole(made), held], metric) for held in (False, True))
        rows = rows.withColumn("_held", rank.isNull()).drop("_ranks").persist()
        model = fitted(make_estimator(), rows.where(~F.col("_held")).drop("_held"), score_fn)
        found = ev(score_fn(model, rows) if score_fn else model.transform(rows), "_held")  # both parts from one pass
        rows.unpersist()
        _let_go(model)
        return float(frac), size, f, found[False], found[True]

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        rows = list(pool.map(one, [(f, frac) for f in range(k) for frac in fractions]))
    schema = StructType([StructField("fraction", DoubleType()), StructField("n_train", LongType()),
                         StructField("fold", IntegerType()), StructField("train_score", DoubleType()),
                         StructField("val_score", DoubleType())])
    return spark.createDataFrame(rows, schema)


def validation_curve(make_estimator, param: str, values: list, df: DataFrame, k: int,
                     label: str = "label", fold_col: str = "fold", score_fn=None,
                     parallelism: int = 2) -> DataFrame:
    """F1 of class 1 on train and validation folds for each parameter value.
    The (value, fold) fits run ``parallelism`` at a time from driver threads;
    forests that differ only in depth or tree count are cuts of one a fold.

    Output (param, value, fold, train_score, val_score).
    """
    from concurrent.futures import ThreadPoolExecutor

    from classbench.models.forest_parts import metric_of, part_cells, part_counts, plain_rows

    spark = df.sparkSession
    ev = _metric_fn("f1", label)
    made = [_forest_of(lambda v=v: make_estimator(**{param: v}), score_fn) for v in values]
    whole = None
    if made and all(e is not None for e in made) and len({_family(e) for e in made}) == 1:
        whole = made[0].copy({made[0].numTrees: max(e.getNumTrees() for e in made), made[0].maxDepth: max(e.getMaxDepth() for e in made)})
        kept = plain_rows(df.where(F.col(fold_col).isNotNull()), whole, F.col(fold_col).alias("fold")).persist()

    def cuts_of_one(f):
        parts = part_cells(kept, F.col("fold") == f, whole.getMaxBins())
        counts = part_counts(parts, parts.grow(whole), [_whole(e) for e in made])
        return [(param, float(v), f, *(metric_of(counts[_whole(e), held], "f1") for held in (False, True))) for v, e in zip(values, made)]

    def one(vf):
        v, f = vf
        rows = df.where(F.col(fold_col).isNotNull()).withColumn("_held", F.col(fold_col) == f)
        model = fitted(make_estimator(**{param: v}), rows.where(~F.col("_held")).drop("_held"), score_fn)
        found = ev(score_fn(model, rows) if score_fn else model.transform(rows), "_held")  # both parts from one pass
        _let_go(model)
        return param, float(v), f, found[False], found[True]

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        rows = list(pool.map(one, [(v, f) for v in values for f in range(k)])) if whole is None else [r for part in pool.map(cuts_of_one, range(k)) for r in part]
    if whole is not None:
        kept.unpersist()
    schema = StructType([StructField("param", StringType()), StructField("value", DoubleType()),
                         StructField("fold", IntegerType()), StructField("train_score", DoubleType()),
                         StructField("val_score", DoubleType())])
    return spark.createDataFrame(rows, schema)


def tree_count_curve(df: DataFrame, k: int, sizes: list[int] = tuple(VALIDATION_RANGES["n_estimators"]), label: str = "label",
                     fold_col: str = "fold", parallelism: int = 2, **forest_args) -> DataFrame:
    """T7 over tree counts: F1 of class 1 of the first ``size`` trees of one forest a fold, for every size.

    ``k`` fits of the largest size instead of one for each size and fold.
    Output (param, value, fold, train_score, val_score).
    """
    from concurrent.futures import ThreadPoolExecutor

    from classbench.models.forest import forest
    from classbench.models.forest_parts import f1_with_bare, part_cells, part_counts, plain_rows

    est = forest(max(sizes), label=label, **forest_args)
    kept = plain_rows(df.where(F.col(fold_col).isNotNull()), est, F.col(fold_col).alias("fold")).persist()

    def one(f):
        parts = part_cells(kept, F.col("fold") == f, est.getMaxBins())
        counts = part_counts(parts, parts.grow(est), [(s, est.getMaxDepth(), 2) for s in sizes])
        return [("n_estimators", float(s), f, *(f1_with_bare(counts[(s, est.getMaxDepth(), 2), held]) for held in (False, True))) for s in sizes]

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        rows = [r for part in pool.map(one, range(k)) for r in part]
    kept.unpersist()
    return df.sparkSession.createDataFrame(rows, "param string, value double, fold int, train_score double, val_score double")


def forest_grid(df: DataFrame, k: int, grid: dict | None = None, label: str = "label", fold_col: str = "fold",
                parallelism: int = 2) -> DataFrame:
    """T1-T3 of a forest grid in the reference's names: (point, params, fold, f1, best).

    Points that differ only in tree count, depth or ``min_samples_split`` are prefixes,
    cuts and prunings of one forest, which is fitted once a fold; ``best`` marks the
    point of highest mean F1 of class 1 (ties: the first).
    """
    from concurrent.futures import ThreadPoolExecutor

    from classbench.models.forest import forest
    from classbench.models.forest_parts import f1_with_bare, part_cells, part_counts, plain_rows

    points = grid_points(grid or FOREST_APP_DEFAULT)
    own = lambda p: (p.get("min_samples_leaf", 1), p.get("max_features", "sqrt"))
    variant = lambda p: (p.get("n_estimators", 100), forest(1, p.get("max_depth")).getMaxDepth(), p.get("min_samples_split", 2))
    groups: dict[tuple, list] = {}
    for p in points:
        groups.setdefault(own(p), []).append(variant(p))
    ests = {o: forest(max(v[0] for v in vs), max(v[1] for v in vs), min_samples_leaf=o[0], max_features=o[1], label=label) for o, vs in groups.items()}
    kept = plain_rows(df.where(F.col(fold_col).isNotNull()), next(iter(ests.values())), F.col(fold_col).alias("fold")).persist()

    def one(job):
        o, f = job
        counts = part_counts(parts[f], parts[f].grow(ests[o]), groups[o])
        return {(o, f, v): f1_with_bare(counts[v, True]) for v in groups[o]}

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        parts = list(pool.map(lambda f: part_cells(kept, F.col("fold") == f, next(iter(ests.values())).getMaxBins()), range(k)))  # growth settings share cells
        found = {key: f1 for part in pool.map(one, [(o, f) for o in groups for f in range(k)]) for key, f1 in part.items()}
    kept.unpersist()
    f1 = [[found[own(p), f, variant(p)] for f in range(k)] for p in points]
    mean = [sum(row) / k for row in f1]
    best = mean.index(max(mean))
    rows = [(i, ", ".join(f"{n}={v}" for n, v in p.items()), f, f1[i][f], i == best) for i, p in enumerate(points) for f in range(k)]
    return df.sparkSession.createDataFrame(rows, "point int, params string, fold int, f1 double, best boolean")
