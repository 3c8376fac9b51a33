"""classbench: supervised classification on tables, expressed as Spark jobs.

Layout
------
sources/    readers, fixtures built from the given tables, sinks
functions/  column-expression helpers (JVM-side, codegen friendly)
operators/  profiling, encoding, exact ranks and splits, metrics, curves
models/     forest, kernel-map SVM, feed-forward network estimators
plans/      tuning, resampling and the end-to-end analysis runs
"""

__version__ = "0.1.0"

# The most used entry points, importable from the package root.
from classbench.operators.curves import pr_curve, roc_auc, roc_curve  # noqa: E402,F401
from classbench.operators.metrics import (binary_metrics, classification_report,  # noqa: E402,F401
                                          confusion_matrix, weighted_metrics)
from classbench.operators.profile import (class_share, describe, histogram, shape,  # noqa: E402,F401
                                          value_counts)
from classbench.operators.split import stratified_kfold, stratified_split, three_way_split  # noqa: E402,F401
from classbench.plans.prepare import prepare_table  # noqa: E402,F401
