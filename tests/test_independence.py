"""Same result whatever the input partitioning."""

import pytest

from classbench.operators import curves, metrics, profile, split
from classbench.sources import fixtures as FX
from tests.conftest import SF_SMALL


def _rows(df, digits=9):
    out = []
    for r in df.collect():
        out.append(tuple(round(v, digits) if isinstance(v, float) else v for v in r))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def scored(spark):
    return FX.scored(spark, SF_SMALL).persist()


@pytest.mark.parametrize("op", ["roc", "pr", "auc", "confusion", "report", "hist", "describe", "split",
                                "kfold_ordered", "tail"])
def test_partition_count_does_not_change_results(scored, op):
    def run(d):
        if op == "roc":
            return curves.roc_curve(d)
        if op == "pr":
            return curves.pr_curve(d)
        if op == "auc":
            return curves.roc_auc(d)
        if op == "confusion":
            return metrics.confusion_matrix(d)
        if op == "report":
            return metrics.classification_report(d)
        if op == "hist":
            return profile.histogram(d, "score", 10, group="label")
        if op == "describe":
            return profile.describe(d, ["score", "label"])
        if op == "kfold_ordered":
            return split.stratified_kfold(d, "id", "label", 4, shuffle=False, rows_per_bucket=50)
        if op == "tail":
            return split.tail_holdout(d, "id", 0.3, rows_per_bucket=50)
        return split.stratified_split(d, "id", "label", 0.25, 7)
    base = _rows(run(scored.repartition(1)))
    for p in (4, 16):
        assert _rows(run(scored.repartition(p))) == base
