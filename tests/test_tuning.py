import pytest
from pyspark.sql import functions as F

from classbench.models.forest import forest, score
from classbench.operators import split
from classbench.plans import tuning
from tests.conftest import SF_SMALL


def test_grid_sizes():
    assert tuning.grid_sizes() == {"forest": 216, "forest_app_default": 16, "svm_linear": 4,
                                   "svm_rbf": 24, "svm_poly": 18, "svm_sigmoid": 6}


@pytest.fixture(scope="module")
def folded(spark):
    from classbench.plans.forest_run import prepare_churn
    data, _ = prepare_churn(spark, SF_SMALL)
    f = split.stratified_kfold(data, "id", "label", 3, 42)
    return f.persist()


def test_cv_scores_one_fit_per_fold(folded):
    t = tuning.cv_scores(lambda: forest(5, 4), folded, 3, model_name="rf", score_fn=score)
    rows = t.collect()
    assert len(rows) == 15 and {r["metric"] for r in rows} == {"accuracy", "precision", "recall", "f1", "roc_auc"}


def test_grid_search_matches_manual_loop(folded):
    est = forest(5, 4)
    pm = tuning.param_grid(est, {"maxDepth": [2, 4]})
    best, table = tuning.grid_search(est, pm, folded, 3, parallelism=1)
    got = {r["point"]: r["mean_f1"] for r in table.collect()}
    ev = tuning.f1_positive()
    for i, depth in enumerate([2, 4]):
        vals = []
        for f in range(3):
            m = forest(5, depth).fit(folded.where(F.col("fold") != f))
            vals.append(ev.evaluate(m.transform(folded.where(F.col("fold") == f))))
        assert got[i] == pytest.approx(sum(vals) / 3)


def test_learning_curve_nested_exact_sizes(folded):
    t = tuning.learning_curve(lambda: forest(3, 3), folded, 2, fractions=[0.5, 1.0], score_fn=score).collect()
    for f in range(2):
        n_train = folded.where(F.col("fold") != f).count()
        sizes = sorted(r["n_train"] for r in t if r["fold"] == f)
        assert sizes == [int(0.5 * n_train), n_train]


def test_complete_forest_run(spark):
    from classbench.plans.forest_run import run_complete_analysis
    run = run_complete_analysis(spark, SF_SMALL, num_trees=10, max_depth=6, cv_folds=3,
                                grid={"n_estimators": [5], "max_depth": [3, 6]}, tune_folds=2)
    t = run.tables
    assert {"test_metrics", "confusion", "roc", "pr", "importance", "cv", "grid"} <= set(t)
    assert t["grid"].count() == 2 and t["confusion"].count() == 4
    assert t["cv"].count() == 15
    assert abs(sum(r["importance"] for r in t["importance"].collect()) - 1.0) < 1e-9
    run.close()
