"""DataFrame operators: profiling, encoding, ranks, splits, metrics, curves."""
