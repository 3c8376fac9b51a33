"""Kernel SVM estimator: landmarks, side-by-side training, grids, support vectors, saving."""

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from classbench.models.kernel_svc import KernelSVC, LandmarkTable, fit_all, grid_search, held_out_decisions, smooth_hinge
from classbench.models import kernel_svc
from classbench.models.lbfgs import minimise_all
from classbench.models.sums import sum_vectors
from classbench.models.svm import pick_landmarks, pooled_variance
from classbench.operators.split import hash_rank


def ring(spark, n=600, parts=3):
    rng = np.random.default_rng(3)
    x = rng.normal(0, 1, (n, 2))
    y = ((x ** 2).sum(1) > 1.4).astype(int)
    rows = [(i, Vectors.dense(v.tolist()), int(t)) for i, (v, t) in enumerate(zip(x, y))]
    schema = StructType([StructField("id", LongType()), StructField("features", VectorUDT()), StructField("label", IntegerType())])
    return spark.createDataFrame(rows, schema).repartition(parts), x, y


def test_minimise_all_finds_each_minimum():
    rng = np.random.default_rng(1)
    hessians = [np.diag(rng.uniform(0.01, 100, 5)) for _ in range(4)]
    targets = [rng.normal(0, 3, 5) for _ in range(4)]

    def evaluate(which, points):
        return [(0.5 * (w - targets[i]) @ hessians[i] @ (w - targets[i]), hessians[i] @ (w - targets[i])) for i, w in zip(which, points)]
    found = minimise_all(evaluate, [np.zeros(5)] * 4, 300, 1e-9)
    assert all(np.allclose(w, t, atol=1e-4) for w, t in zip(found, targets))


def test_smooth_hinge_gradient():
    m = np.linspace(-2, 2, 401)
    value, slope = smooth_hinge(m)
    assert np.allclose((smooth_hinge(m + 1e-6)[0] - smooth_hinge(m - 1e-6)[0]) / 2e-6, slope, atol=1e-4)
    assert (value[m >= 1] == 0).all() and (np.abs(value - np.maximum(1 - m, 0)) <= 0.05 + 1e-12).all()


def test_landmarks_are_those_of_the_full_ranking(spark):
    df, x, _ = ring(spark, 500, 7)
    ranked, counts = hash_rank(df, "id", "label", 42, "landmark|")
    quota = {k[0]: max(1, round(60 * c / 500)) for k, c in counts}
    want = {tuple(r.features) for r in ranked.collect() if r["_rank"] <= quota[r.label]}
    for parts in (1, 5):
        got = pick_landmarks(df.repartition(parts), 60)
        assert {tuple(v) for v in got} == want and len(got) == len(want)
    assert np.isclose(pooled_variance(df), x.var())


def test_side_by_side_equals_alone_and_any_partition_count(spark):
    df, x, y = ring(spark)
    found = []
    for parts in (1, 4, 16):
        table = LandmarkTable(df.repartition(parts), 3, 40)
        points = [table.point("rbf", {"C": 1, "gamma": 0.5}), table.point("rbf", {"C": 10, "gamma": 0.5}), table.point("poly", {"degree": 2}),
                  table.point("linear", {"C": 0.1}), table.point("sigmoid", {"gamma": "auto"})]
        found.append(fit_all(table, points, [0, 1, 2, -1]))
        if parts == 1:
            close = {(f.point, f.fold): f.weights for f in fit_all(table, [points[0], points[3]], [0, -1], 300, 1e-7)}
            alone = [fit_all(table, [p], [f], 300, 1e-7)[0] for p, f in ((points[0], 0), (points[3], -1))]
            decisions = held_out_decisions(table, [f for f in found[0] if f.fold >= 0]).collect()
            held = {(r["id"], r.fold): r for r in table.rows.select("id", "fold").collect()}
            assert len(decisions) == len(points) * len(held)
        table.close()
    for other in found[1:]:
        assert all(np.allclose(a.weights, b.weights, rtol=1e-6, atol=1e-6) for a, b in zip(found[0], other))
    # alone, products round differently: the same minimum, reached another way
    assert all(np.allclose(a.weights, close[a.point, a.fold], rtol=1e-3, atol=1e-3) for a in alone)
    # the minimum of the stated objective: no step in a random direction lowers it
    table = LandmarkTable(df, 0, 40)
    point = table.point("rbf", {"C": 1, "gamma": 0.5})
    fit = fit_all(table, [point], [-1], 200, 1e-6)[0]
    fmap = table.map_of(point)
    k = np.exp(-0.5 * ((x[:, None] - fmap.landmarks[None]) ** 2).sum(2)) @ fmap.proj

    def objective(w):
        return smooth_hinge((2 * y - 1) * (k @ w[:-1] + w[-1]))[0].mean() + w[:-1] @ w[:-1] / (2 * 600)
    rng = np.random.default_rng(5)
    least = objective(fit.weights)
    assert all(objective(fit.weights + rng.normal(0, s, len(fit.weights))) >= least - 1e-5 for s in (1e-3, 1e-2, 0.1) for _ in range(50))
    table.close()


def test_grid_scores_and_best(spark):
    df, _, _ = ring(spark)
    table = LandmarkTable(df, 4, 60)
    grid = [{"C": c, "gamma": g} for c in (0.1, 10) for g in ("scale", 0.01)]
    scores, best, refit = grid_search(table, "rbf", grid)
    rows = scores.collect()
    assert len(rows) == 16 and {r.params for r in rows} == {f"C={c}, gamma={g}" for c in (0.1, 10) for g in ("scale", 0.01)}
    mean = {i: np.mean([r.f1 for r in rows if r.point == i]) for i in range(4)}
    top = max(mean, key=mean.get)
    assert {(r.param, r.value) for r in best.collect()} == {("C", str(grid[top]["C"])), ("gamma", str(grid[top]["gamma"]))}
    assert refit.fold == -1 and mean[top] > 0.95
    # F1 of one point and fold from its decisions
    fitted = fit_all(table, [table.point("rbf", grid[top])], [2])
    d = held_out_decisions(table, fitted).toPandas()
    tp = ((d.decision > 0) & (d.label == 1)).sum()
    f1 = 2 * tp / (2 * tp + ((d.decision > 0) != (d.label == 1)).sum())
    assert np.isclose(f1, next(r.f1 for r in rows if r.point == top and r.fold == 2))
    table.close()
    with pytest.raises(ValueError):
        table.point("cubic", {})


@pytest.mark.parametrize("kernel", ["linear", "rbf", "poly", "sigmoid"])
def test_estimator_saves_and_loads_in_a_pipeline(spark, tmp_path, kernel):
    df, _, y = ring(spark)
    model = Pipeline(stages=[KernelSVC(kernel=kernel, degree=2, coef0=1.0, numLandmarks=50, calibrationFolds=3)]).fit(df)
    model.write().overwrite().save(str(tmp_path / "svm"))
    again = PipelineModel.load(str(tmp_path / "svm"))
    a, b = (m.transform(df).orderBy("id").select("decision", "score", "prediction").toPandas() for m in (model, again))
    assert np.allclose(a, b, atol=0) and ((a.decision > 0) == (a.prediction == 1)).all() and a.score.between(0, 1).all()
    svc = again.stages[0]
    assert svc.getOrDefault("kernel") == kernel and svc.intercept == model.stages[0].intercept
    margin = (2 * y - 1) * a.decision.to_numpy()
    got = {r.label: r for r in svc.support_vectors(df).collect()}
    assert {c: r.n_support for c, r in got.items()} == {c: int(((margin <= 1.001) & (y == c)).sum()) for c in (0, 1)}
    assert got[0].total == got[0].n_support + got[1].n_support and got[1].intercept == svc.intercept
    if kernel in ("rbf", "poly"):
        assert ((a.prediction == 1) == (y == 1)).mean() > 0.95


def test_estimator_on_odd_columns(spark):
    df, _, _ = ring(spark, 200)
    odd = df.withColumn("fold", F.lit("x")).withColumn("products", F.lit(1)).withColumn("x", F.lit(2)).withColumn("norm", F.lit(3))
    out = KernelSVC(numLandmarks=20, calibrationFolds=0).fit(odd).transform(odd)
    assert out.where("prediction = label").count() > 180
    assert out.columns == [*odd.columns, "decision", "score", "prediction"] and out.count() == 200


def test_descent_over_all_rows_from_the_end_of_a_small_one(spark, monkeypatch):
    """Fewer passes over all rows, the same minimum to the same tolerance."""
    rng = np.random.default_rng(5)
    x = rng.normal(0, 1, (1200, 2))
    y = (x[:, 0] + 0.5 * x[:, 1] + rng.normal(0, 0.5, 1200) > 0.3).astype(int)
    df = spark.createDataFrame([(i, Vectors.dense(v.tolist()), int(t)) for i, (v, t) in enumerate(zip(x, y))],
                               StructType([StructField("id", LongType()), StructField("features", VectorUDT()), StructField("label", IntegerType())])).coalesce(2)
    passes, weights = {}, {}
    for first in (1 << 17, 300):
        monkeypatch.setattr(kernel_svc, "FIRST_ROWS", first)
        table = LandmarkTable(df, 0, 10)
        assert (table.first is not None) == (first == 300)
        seen, every = [], table.rows.count()
        monkeypatch.setattr(kernel_svc, "sum_vectors", lambda rows, f, n=seen: n.append(rows.count()) or sum_vectors(rows, f))
        weights[first] = fit_all(table, [table.point("linear", {"C": 1.0})], [-1], 60, 1e-3)[0].weights
        passes[first] = seen.count(every)
        table.close()
    assert passes[300] < passes[1 << 17]
    assert np.allclose(weights[300], weights[1 << 17], rtol=0.05, atol=0.02)


def test_memory_and_lengths_start_a_descent():
    hessian, target = np.diag([0.01, 1.0, 100.0]), np.array([1.0, -2.0, 3.0])
    seen = []

    def evaluate(which, points):
        seen.append(1)
        return [(0.5 * (w - target) @ hessian @ (w - target), hessian @ (w - target)) for w in points]
    memory = [[]]
    near = minimise_all(evaluate, [np.zeros(3)], 300, 1e-6, memory=memory)
    cold, seen[:] = len(seen), []
    length = [float(np.linalg.norm(hessian @ target))]
    found = minimise_all(evaluate, [near[0] + 0.01], 300, 1e-6, length, memory)
    assert memory[0] and len(seen) < cold and np.allclose(found[0], target, atol=1e-3)


def test_power_of_a_kernel_without_logarithms():
    x = np.random.default_rng(2).normal(size=(5, 7))
    for degree in range(6):
        assert np.allclose(kernel_svc._power(x.copy(), degree), x ** degree, rtol=1e-12)


def test_inverse_of_second_derivatives_shortens_a_descent():
    """An ill-conditioned problem near its minimum takes a few evaluations."""
    rng = np.random.default_rng(4)
    q, _ = np.linalg.qr(rng.normal(size=(40, 40)))
    hessian = q * np.logspace(-5, 2, 40) @ q.T
    target, seen = rng.normal(size=40), []

    def evaluate(which, points):
        seen.append(1)
        return [(0.5 * (w - target) @ hessian @ (w - target), hessian @ (w - target)) for w in points]
    about = np.linalg.inv(hessian * 1.1 + 1e-6 * np.eye(40))
    found = minimise_all(evaluate, [np.zeros(40)], 60, 1e-7, inverses=[about])
    assert len(seen) < 20 and np.allclose(found[0], target, atol=1e-2)
    seen[:] = []
    plain = minimise_all(evaluate, [np.zeros(40)], 60, 1e-7)
    assert len(seen) > 50 and not np.allclose(plain[0], target, atol=1e-2)


def test_few_evaluations_over_all_rows_for_a_stiff_kernel(spark, monkeypatch):
    """Second derivatives of few rows lead all rows to the tolerance well within the limit."""
    rng = np.random.default_rng(6)
    x = rng.normal(0, 1, (4000, 2))
    y = ((x ** 2).sum(1) + rng.normal(0, 1, 4000) > 1.4).astype(int)
    df = spark.createDataFrame([(i, Vectors.dense(v.tolist()), int(t)) for i, (v, t) in enumerate(zip(x, y))],
                               StructType([StructField("id", LongType()), StructField("features", VectorUDT()), StructField("label", IntegerType())])).coalesce(2)
    monkeypatch.setattr(kernel_svc, "FIRST_ROWS", 1900)
    table = LandmarkTable(df, 0, 12)
    passes = []
    monkeypatch.setattr(kernel_svc, "sum_vectors", lambda rows, f: passes.append(rows.count()) or sum_vectors(rows, f))
    fit_all(table, [table.point("rbf", {"C": 10, "gamma": 0.5})], [-1], 100)
    assert 1 < passes.count(4000) < 15
    table.close()


def test_tuned_models_reuse_the_fits_of_their_grid(spark, monkeypatch):
    """F16: the best point's folds are not fitted a second time."""
    from classbench.plans import svm_run, tuning

    df, _, _ = ring(spark, 300, 2)
    monkeypatch.setitem(tuning.SVM_GRIDS, "linear", {"C": [0.1, 1]})
    fitted = []
    monkeypatch.setattr(kernel_svc, "fit_all", lambda *a, **k: fitted.append(len(a[1])) or fit_all(*a, **k))
    scores, best, models = svm_run.tuned_svms(df, ["linear"], 2, 10)
    assert fitted == [2] and scores.count() == 4 and set(models) == {"linear"}


def test_score_tables_take_little_room(spark):
    """distinct scores are written as a table, not as serialised rows."""
    from classbench.operators.curves import running_counts

    df = spark.range(20000, numPartitions=1).select((F.col("id") % 2).alias("label"), F.rand(1).alias("score"))
    _, table = running_counts(df, "label", "score", with_table=True)
    files = table.inputFiles()
    assert files and all(f.endswith(".parquet") for f in files) and table.count() == 20000
