"""Estimators: random forest (built-in), kernel-map SVM, feed-forward network."""
