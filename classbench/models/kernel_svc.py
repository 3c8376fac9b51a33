"""Kernel SVM as a ``pyspark.ml`` estimator, with grid search over one landmark table.

Rows are written once as a narrow table of features.  A pass computes their
inner products with the landmarks, a piece of a batch at a time; each kernel,
gamma and degree is a function of those products.  No mapped row is stored or
sent.  All grid points, folds and refits are trained side by side: an optimiser step of all of
them is one pass over the table, whose losses and gradients are added up over
the partitions; the driver holds weights and sums only.  A descent over
``FIRST_ROWS`` rows finds the place from which the descent over all rows starts,
and the second derivatives of these rows give its steps; where it ends is
decided by all rows alone, by the same tolerance as from zero weights.

The loss is the hinge, rounded off by a parabola over ``SMOOTHING`` before the
margin so that it has a gradient; the regularisation is that of the C-weighted
dual solver, 1 / (C * n).  Non-linear kernels are approximated from
``numLandmarks`` landmarks (see ``svm``).
"""

from __future__ import annotations

import json
import time
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasMaxIter, HasPredictionCol, HasSeed, HasTol
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from classbench.models.lbfgs import minimise_all
from classbench.models.sums import matrix, sum_vectors
from classbench.models.svm import KERNELS, NystroemMap, _platt, nystroem_map, pick_landmarks, pooled_variance, resolve_gamma
from classbench.operators.split import stratified_kfold
from classbench.session import new_scratch_path, ship_by_value

SMOOTHING = 0.1
_SELF = __import__(__name__, fromlist=["_"])


def smooth_hinge(margin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Loss and its derivative: 0 above 1, linear below 1 - SMOOTHING, a parabola between."""
    short = 1.0 - margin
    inside = np.clip(short, 0.0, SMOOTHING)
    return inside ** 2 / (2 * SMOOTHING) + np.maximum(short - SMOOTHING, 0.0), -inside / SMOOTHING


@dataclass(frozen=True)
class Point:
    """One grid point: a kernel with its parameters (gamma resolved to a number) and C."""

    kernel: str
    C: float
    gamma: float = 0.0
    degree: int = 3
    coef0: float = 0.0
    shown: tuple = ()  # parameter names and values as the grid has them

    def map_key(self) -> tuple:
        return (self.kernel,) if self.kernel == "linear" else (self.kernel, self.gamma, self.degree, self.coef0)


class LandmarkTable:
    """Rows (id, label, fold, x) of a training frame and its landmarks, persisted until ``close``."""

    def __init__(self, df: DataFrame, folds: int, n_landmarks: int = 256, features: str = "features", label: str = "label",
                 id_col: str = "id", seed: int = 42, fold_col: str | None = None):
        kept = df.is_cached
        df = df.select(id_col, label, features, *([fold_col] if fold_col else []))  # read by the passes below
        if not kept:
            df.persist()
        self.folds, self.landmarks = folds, pick_landmarks(df, n_landmarks, features, label, id_col, seed)
        self.variance = pooled_variance(df, features)
        narrow = df.select(F.col(id_col).alias("id"), F.col(label).cast("int").alias("label"), vector_to_array(F.col(features)).alias("x"),
                           *([F.col(fold_col).cast("int").alias("fold")] if fold_col else []))
        if not fold_col:
            narrow = stratified_kfold(narrow, "id", "label", folds, seed) if folds else narrow.withColumn("fold", F.lit(0))
        narrow = narrow.select("id", "label", "fold", "x")
        path = new_scratch_path(df.sparkSession, "landmarks")
        narrow.write.parquet(path)
        if not kept:
            df.unpersist()
        # rows that do not fit the memory are read from the table again, not written a second time
        self.rows = df.sparkSession.read.schema(narrow.schema).parquet(path).persist(StorageLevel.MEMORY_ONLY)
        sizes = {(r["fold"], r["label"]): r["n"] for r in self.rows.groupBy("fold", "label").agg(F.count("*").alias("n")).collect()}
        self.n = sum(sizes.values())
        self.fold_sizes = {f: sum(n for (g, _), n in sizes.items() if g == f) for f in range(folds)}
        self.feature_count = self.landmarks.shape[1]
        self.first = None
        if self.n > 2 * FIRST_ROWS:
            share = FIRST_ROWS / self.n
            picked = F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(1 << 20)) < int(share * (1 << 20))
            self.first = self.rows.where(picked).persist(StorageLevel.MEMORY_ONLY)
            self.first_sizes = {r["fold"]: r["n"] for r in self.first.groupBy("fold").agg(F.count("*").alias("n")).collect()}
            if not self.first_sizes:
                self.first = None

    def point(self, kernel: str, params: dict) -> Point:
        if kernel not in KERNELS:
            raise ValueError(f"kernel must be one of {KERNELS}")
        gamma = resolve_gamma(params.get("gamma", "scale"), self.feature_count, self.variance)
        return Point(kernel, float(params.get("C", 1.0)), 0.0 if kernel == "linear" else gamma, int(params.get("degree", 3)),
                     float(params.get("coef0", 0.0)), tuple(sorted(params.items())))

    def map_of(self, point: Point) -> NystroemMap | None:
        if point.kernel == "linear":
            return None
        return nystroem_map(self.landmarks, point.kernel, point.gamma, point.degree, point.coef0)

    def close(self) -> None:
        """Give the memory back; the landmarks, and so ``point`` and ``map_of``, stay."""
        self.rows.unpersist()
        if self.first is not None:
            self.first.unpersist()


#: Rows, about, of the descent whose end is the start of that over all rows.
FIRST_ROWS = 1 << 17
#: Evaluations over these rows before their second derivatives are taken, times they are taken, and evaluations after each.
FIRST_PASSES, ROUNDS, ROUND_PASSES = 20, 4, 8
#: Tasks that add up second derivatives, and their least size beside the largest.
CURVED_TASKS, LEAST_CURVE = 8, 1e-6
#: Rows whose products with the landmarks are held at a time: few enough for their kernel values to stay in the processor's cache.
PIECE = 512


def _pieces(batch: pa.RecordBatch, landmarks: np.ndarray):
    """(label, fold, x, products, norm) of a batch of (label, fold, x), in pieces of ``PIECE`` rows."""
    for at in range(0, batch.num_rows, PIECE):
        part = batch.slice(at, PIECE)
        x = matrix(part.column(2))
        yield part.column(0).to_numpy(zero_copy_only=False), part.column(1).to_numpy(zero_copy_only=False), x, x @ landmarks.T, (x * x).sum(1)


def kernel_from_products(key: tuple, products: np.ndarray, norm: np.ndarray, own: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Kernel values with the landmarks (of norms ``own``), or the features themselves for the linear kernel."""
    if key[0] == "linear":
        return x
    kind, gamma, degree, coef0 = key
    if kind == "rbf":
        k = products * -2.0
        k += norm[:, None]
        k += own
        np.maximum(k, 0.0, out=k)
        k *= -gamma
        return np.exp(k, out=k)
    k = products * gamma
    k += coef0
    return _power(k, degree) if kind == "poly" else np.tanh(k, out=k)


def _power(base: np.ndarray, degree: int) -> np.ndarray:
    """``base ** degree`` by squaring, without the logarithms of a general power."""
    out = None
    while degree:
        if degree & 1:
            out = base if out is None else out * base
        degree >>= 1
        if degree:
            base = base * base
    return np.ones_like(base) if out is None else out


@dataclass
class Fitted:
    """Weights (then the intercept) of one grid point with one fold left out (-1: none)."""

    point: Point
    fold: int
    weights: np.ndarray


def _by_map(problems: list[tuple[Point, int]]) -> dict[tuple, list[int]]:
    groups: dict[tuple, list[int]] = {}
    for i, (p, _) in enumerate(problems):
        groups.setdefault(p.map_key(), []).append(i)
    return groups


def fit_all(table: LandmarkTable, points: list[Point], folds: list[int], max_iter: int = 100, tol: float = 1e-3) -> list[Fitted]:
    """Every point with every fold of ``folds`` left out (-1: none), trained side by side."""
    problems = [(p, f) for p in points for f in folds]
    maps = {p.map_key(): table.map_of(p) for p in points}
    proj = {k: np.eye(table.feature_count) if m is None else m.proj for k, m in maps.items()}
    lm, own = table.landmarks, (table.landmarks ** 2).sum(1)
    size = [max(table.n - table.fold_sizes.get(f, 0), 1) for _, f in problems]
    ridges = [1.0 / (p.C * n) for (p, _), n in zip(problems, size)]
    # each weight is measured in units of its feature's spread over the landmarks, so that all curve alike
    products, norms = table.landmarks @ table.landmarks.T, own
    spread = {k: ((kernel_from_products(k, products, norms, own, table.landmarks) @ proj[k]) ** 2).mean(0) for k in maps}
    units = [np.concatenate([1.0 / np.sqrt(spread[p.map_key()] + r), [1.0]]) for (p, _), r in zip(problems, ridges)]

    def planned(which, scaled):
        plan, weights = [], [u * units[i] for i, u in zip(which, scaled)]
        for key, members in _by_map([problems[i] for i in which]).items():
            w = np.array([weights[j] for j in members])
            plan.append((key, members, proj[key] @ w[:, :-1].T, w[:, -1], np.array([problems[which[j]][1] for j in members])))
        return plan, weights

    def over(rows, size):
        rows = rows.select("label", "fold", "x")

        def evaluate(which, scaled):
            plan, weights = planned(which, scaled)

            def partial(batches):
                loss, grads = np.zeros(len(which)), [np.zeros((v.shape[0] + 1, v.shape[1])) for _, _, v, _, _ in plan]
                for y, fold, x, products, norm in (p for batch in batches for p in _pieces(batch, lm)):
                    y = 2.0 * y - 1.0
                    for (key, members, v, b, left_out), grad in zip(plan, grads):
                        k = kernel_from_products(key, products, norm, own, x)
                        value, slope = smooth_hinge(y[:, None] * (k @ v + b))
                        used = fold[:, None] != left_out[None, :]
                        loss[members] += (value * used).sum(0)
                        slope = slope * used * y[:, None]
                        grad[:-1] += k.T @ slope
                        grad[-1] += slope.sum(0)
                return np.concatenate([loss, *[g.ravel() for g in grads]])

            total = sum_vectors(rows, partial)
            out, at = [None] * len(which), len(which)
            for key, members, v, _, _ in plan:
                grad = total[at:at + (v.shape[0] + 1) * v.shape[1]].reshape(v.shape[0] + 1, v.shape[1])
                at += grad.size
                back = np.vstack([proj[key].T @ grad[:-1], grad[-1:]])
                for c, j in enumerate(members):
                    n, ridge, plain = size[which[j]], ridges[which[j]], np.concatenate([weights[j][:-1], [0.0]])
                    out[j] = (total[j] / n + 0.5 * ridge * float(plain @ plain), (back[:, c] / n + ridge * plain) * units[which[j]])
            return out
        return evaluate

    def inverses(rows, size, scaled):
        """Inverses of the losses' second derivatives over few rows, in scaled weights; only rows on the parabola bend the loss."""
        plan, _ = planned(list(range(len(problems))), scaled)
        wide = [v.shape[0] + 1 for _, _, v, _, _ in plan]

        def partial(batches):
            sums = [np.zeros((len(members), w, w)) for (_, members, _, _, _), w in zip(plan, wide)]
            for y, fold, x, products, norm in (p for batch in batches for p in _pieces(batch, lm)):
                y = 2.0 * y - 1.0
                for (key, _, v, b, left_out), total in zip(plan, sums):
                    k = kernel_from_products(key, products, norm, own, x)
                    short = 1.0 - y[:, None] * (k @ v + b)
                    bent = (short > 0) & (short < SMOOTHING) & (fold[:, None] != left_out[None, :])
                    k = np.column_stack([k, np.ones(len(k))])
                    for c in np.flatnonzero(bent.any(0)):
                        held = k[bent[:, c]]
                        total[c] += held.T @ held
            return np.concatenate([t.ravel() for t in sums])

        total, out, at = sum_vectors(rows.select("label", "fold", "x").coalesce(CURVED_TASKS), partial), [None] * len(problems), 0
        for (key, members, _, _, _), w in zip(plan, wide):
            back = np.zeros((w, proj[key].shape[1] + 1))
            back[:-1, :-1], back[-1, -1] = proj[key], 1.0
            for i in members:
                h = back.T @ total[at:at + w * w].reshape(w, w) @ back / (size[i] * SMOOTHING)
                at += w * w
                h[np.arange(len(h) - 1), np.arange(len(h) - 1)] += ridges[i]
                value, vector = np.linalg.eigh(units[i][:, None] * h * units[i])
                out[i] = vector / np.maximum(value, LEAST_CURVE * value[-1]) @ vector.T
        return out

    start, every = [np.zeros(proj[p.map_key()].shape[1] + 1) for p, _ in problems], over(table.rows, size)
    lengths = curves = None
    if table.first is not None:
        lengths = [float(np.linalg.norm(g)) for _, g in every(list(range(len(problems))), start)]
        held = sum(table.first_sizes.values())
        few = [max(held - table.first_sizes.get(f, 0), 1) for _, f in problems]
        start = minimise_all(over(table.first, few), start, FIRST_PASSES, tol, lengths)
        for _ in range(ROUNDS):
            curves = inverses(table.first, few, start)
            start = minimise_all(over(table.first, few), start, ROUND_PASSES, tol, lengths, inverses=curves)
        max_iter = max(1, max_iter // 3)  # from there, a third as many evaluations end lower than all of them from zero (README)
    found = minimise_all(every, start, max_iter, tol, lengths, inverses=curves)
    return [Fitted(p, f, w * u) for (p, f), w, u in zip(problems, found, units)]


def held_out_decisions(table: LandmarkTable, fitted: list[Fitted]) -> DataFrame:
    """(point, fold, label, decision) of every row by the models that left its fold out; ``point`` numbers the
    distinct points of ``fitted`` in order."""
    order = {p: i for i, p in enumerate(dict.fromkeys(f.point for f in fitted))}
    lm, own = table.landmarks, (table.landmarks ** 2).sum(1)
    plan = []
    for key, members in _by_map([(f.point, f.fold) for f in fitted]).items():
        m = table.map_of(fitted[members[0]].point)
        w = np.array([fitted[i].weights for i in members])
        plan.append((key, w[:, :-1].T if m is None else m.proj @ w[:, :-1].T, w[:, -1],
                     np.array([fitted[i].fold for i in members]), np.array([order[fitted[i].point] for i in members])))

    def decide(batches):
        for y, fold, x, products, norm in (p for batch in batches for p in _pieces(batch, lm)):
            for key, v, b, left_out, point in plan:
                z = kernel_from_products(key, products, norm, own, x) @ v + b
                r, c = np.nonzero(fold[:, None] == left_out[None, :])
                yield pa.RecordBatch.from_arrays([pa.array(point[c], pa.int32()), pa.array(fold[r], pa.int32()), pa.array(y[r], pa.int32()),
                                                  pa.array(z[r, c], pa.float64())], ["point", "fold", "label", "decision"])

    return table.rows.select("label", "fold", "x").mapInArrow(decide, "point int, fold int, label int, decision double")


def grid_search(table: LandmarkTable, kernel: str, points: list[dict], max_iter: int = 100) -> tuple[DataFrame, DataFrame, Fitted]:
    """(scores, best parameters, refit best) of a kernel's grid over the table's folds, see :func:`grid_fits`."""
    scores, best, fits = grid_fits(table, kernel, points, max_iter)
    return scores, best, fits[-1]


def grid_fits(table: LandmarkTable, kernel: str, points: list[dict], max_iter: int = 100) -> tuple[DataFrame, DataFrame, list[Fitted]]:
    """(scores, best parameters, fits of the best point: a fold left out each, then its refit) of a kernel's grid.

    ``scores`` has (kernel, point, params, fold, f1); ``best`` (kernel, param,
    value, mean_f1), where ties go to the first point; the refit was trained
    with the others on all rows.
    """
    made = [table.point(kernel, p) for p in points]
    fitted = fit_all(table, made, [*range(table.folds), -1], max_iter)
    spark = table.rows.sparkSession
    decided = held_out_decisions(table, [f for f in fitted if f.fold >= 0])
    yes, true = F.col("decision") > 0, F.col("label") == 1
    counts = decided.groupBy("point", "fold").agg(F.count_if(yes & true).alias("tp"), F.count_if(yes & ~true).alias("fp"),
                                                  F.count_if(~yes & true).alias("fn")).collect()
    f1 = {(r["point"], r["fold"]): 2 * r["tp"] / max(2 * r["tp"] + r["fp"] + r["fn"], 1) for r in counts}
    text = [", ".join(f"{k}={v}" for k, v in p.shown) for p in made]
    order = {p: i for i, p in enumerate(dict.fromkeys(made))}
    at = [order[p] for p in made]
    scores = spark.createDataFrame([(kernel, i, text[i], f, float(f1.get((at[i], f), 0.0))) for i in range(len(made)) for f in range(table.folds)],
                                   "kernel string, point int, params string, fold int, f1 double")
    mean = [float(np.mean([f1.get((at[i], f), 0.0) for f in range(table.folds)])) for i in range(len(made))]
    top = int(np.argmax(mean))
    best = spark.createDataFrame([(kernel, k, str(v), mean[top]) for k, v in made[top].shown], "kernel string, param string, value string, mean_f1 double")
    own = {f.fold: f for f in fitted if f.point == made[top]}
    return scores, best, [own[f] for f in [*range(table.folds), -1]]


class _KernelParams(HasFeaturesCol, HasLabelCol, HasPredictionCol, HasMaxIter, HasTol, HasSeed):
    kernel = Param(Params._dummy(), "kernel", "linear, rbf, poly or sigmoid", TypeConverters.toString)
    C = Param(Params._dummy(), "C", "weight of the hinge loss", TypeConverters.toFloat)
    gamma = Param(Params._dummy(), "gamma", "'scale', 'auto' or a number, as text", lambda v: str(v))
    degree = Param(Params._dummy(), "degree", "degree of the polynomial kernel", TypeConverters.toInt)
    coef0 = Param(Params._dummy(), "coef0", "constant of the polynomial and sigmoid kernels", TypeConverters.toFloat)
    numLandmarks = Param(Params._dummy(), "numLandmarks", "rows that stand for all in a kernel map", TypeConverters.toInt)
    calibrationFolds = Param(Params._dummy(), "calibrationFolds", "folds whose decisions fit the probabilities; 0: none", TypeConverters.toInt)
    idCol = Param(Params._dummy(), "idCol", "column that orders rows by its hash", TypeConverters.toString)

    def _defaults(self):
        self._setDefault(kernel="rbf", C=1.0, gamma="scale", degree=3, coef0=0.0, numLandmarks=256, calibrationFolds=5, idCol="id",
                         featuresCol="features", labelCol="label", predictionCol="prediction", maxIter=100, tol=1e-3, seed=42)

    def _point_params(self) -> dict:
        gamma = self.getOrDefault("gamma")
        return {"C": self.getOrDefault("C"), "gamma": gamma if gamma in ("scale", "auto") else float(gamma),
                "degree": self.getOrDefault("degree"), "coef0": self.getOrDefault("coef0")}


class KernelSVC(Estimator, _KernelParams, MLWritable, MLReadable):
    """M3-M7: kernel SVM with probabilities calibrated on out-of-fold decisions (labels 0 and 1)."""

    @keyword_only
    def __init__(self, *, kernel="rbf", C=1.0, gamma="scale", degree=3, coef0=0.0, numLandmarks=256, calibrationFolds=5, idCol="id",
                 featuresCol="features", labelCol="label", predictionCol="prediction", maxIter=100, tol=1e-3, seed=42):
        super().__init__()
        self._defaults()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> KernelSVCModel:
        began, g = time.time(), self.getOrDefault
        folds = g("calibrationFolds")
        table = LandmarkTable(df, folds, g("numLandmarks"), g("featuresCol"), g("labelCol"), g("idCol"), g("seed"))
        try:
            point = table.point(g("kernel"), self._point_params())
            fitted = fit_all(table, [point], [*range(folds), -1], g("maxIter"), g("tol"))
            platt = _platt(held_out_decisions(table, fitted[:-1]), "label") if folds else (1.0, 0.0)
            model = KernelSVCModel.of(point, table.map_of(point), fitted[-1].weights, platt, time.time() - began)
        finally:
            table.close()
        return self._copyValues(model)

    def write(self) -> MLWriter:
        return DefaultParamsWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return DefaultParamsReader(cls)


class KernelSVCModel(Model, _KernelParams, MLWritable, MLReadable):
    """A fitted kernel SVM: landmarks, projection, weights, intercept and calibration."""

    def __init__(self):
        super().__init__()
        self._defaults()
        self.spec: dict = {}
        self.landmarks = self.proj = self.weights = np.zeros(0)

    @classmethod
    def of(cls, point: Point, fmap: NystroemMap | None, weights: np.ndarray, platt: tuple[float, float], seconds: float = 0.0) -> KernelSVCModel:
        model = cls()
        model.spec = {"key": list(point.map_key()), "platt": list(platt), "train_seconds": seconds}
        d = len(weights) - 1
        model.landmarks, model.proj = (np.zeros((0, d)), np.eye(d)) if fmap is None else (fmap.landmarks, fmap.proj)
        model.weights = weights
        return model

    @property
    def intercept(self) -> float:
        return float(self.weights[-1])

    def _transform(self, df: DataFrame) -> DataFrame:
        """Adds ``decision``, ``score`` (probability of class 1) and the prediction (the decision's sign)."""
        key, lm, v, b = tuple(self.spec["key"]), self.landmarks, self.proj @ self.weights[:-1], self.intercept
        own = (lm ** 2).sum(1)

        @F.pandas_udf("double")
        def decide(x):
            if not len(x):
                return x.astype(float)
            m = np.stack(x.to_numpy()).astype(float)
            pieces = [m[at:at + PIECE] for at in range(0, len(m), PIECE)]
            return type(x)(np.concatenate([kernel_from_products(key, p @ lm.T, (p * p).sum(1), own, p) @ v + b for p in pieces]))

        a, c = self.spec["platt"]
        out = df.withColumn("decision", decide(vector_to_array(F.col(self.getOrDefault("featuresCol")))))
        return out.withColumn("score", 1.0 / (1.0 + F.exp(-(F.lit(float(a)) * F.col("decision") + F.lit(float(c)))))).withColumn(
            self.getOrDefault("predictionCol"), (F.col("decision") > 0).cast("double"))

    def support_vectors(self, train: DataFrame, tol: float = 1e-3) -> DataFrame:
        """M8 over the training rows: (label, n_support, total, intercept); a support vector lies on or inside the margin."""
        label = self.getOrDefault("labelCol")
        y = F.when(F.col(label) == 1, 1.0).otherwise(-1.0)
        held = self.transform(train.select(label, self.getOrDefault("featuresCol"))).groupBy(F.col(label).cast("int").alias("label")).agg(
            F.count_if(y * F.col("decision") <= 1.0 + tol).alias("n")).collect()  # a row for each of two classes
        total = sum(r["n"] for r in held)
        return train.sparkSession.createDataFrame([(r["label"], r["n"], total, self.intercept) for r in held],
                                                  "label int, n_support long, total long, intercept double")

    def write(self) -> MLWriter:
        return _ModelWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _ModelReader(cls)


class _ModelWriter(MLWriter):
    """Parameters as metadata, arrays as a parquet table (name, row, values)."""

    def __init__(self, model: KernelSVCModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        m = self.model
        DefaultParamsWriter.saveMetadata(m, path, self.sparkSession, {"spec": m.spec})
        rows = [(name, i, r.tolist()) for name in ("landmarks", "proj", "weights")
                for i, r in enumerate(np.atleast_2d(getattr(m, name)))]
        self.sparkSession.createDataFrame(rows, "name string, row int, values array<double>").write.parquet(f"{path}/data")


class _ModelReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> KernelSVCModel:
        meta = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = self.cls()
        model._resetUid(meta["uid"])
        DefaultParamsReader.getAndSetParams(model, meta)
        model.spec = meta["spec"] if isinstance(meta["spec"], dict) else json.loads(meta["spec"])
        rows = self.sparkSession.read.parquet(f"{path}/data").orderBy("name", "row").collect()
        arrays = {k: np.array([r["values"] for r in rows if r["name"] == k], float) for k in ("landmarks", "proj", "weights")}
        model.proj, model.weights = arrays["proj"], arrays["weights"][0]
        model.landmarks = arrays["landmarks"] if len(arrays["landmarks"]) else np.zeros((0, model.proj.shape[0]))
        return model


# executor code of this module travels by value (see session.ship_by_value)
ship_by_value(_SELF)
