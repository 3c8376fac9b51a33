"""Exact stratified splits and folds.

All splits are pure functions of (seed, id, class counts): a row's place is
its exact rank inside its class (``operators.rank``), so the parts are
disjoint, complete and reproducible across runs and partition layouts.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from classbench.operators.rank import (DEFAULT_ROWS_PER_BUCKET, FIXED_HASH_BITS, class_counts,
                                       fold_ranks, hash_bucket, hash_key, rank_with_totals, value_rank)


def hash_rank(df: DataFrame, id_col: str, label: str | None, seed: int = 42, salt: str = "", counts=None):
    """Rank rows inside their class by md5(seed|salt|id), ties by id; with the class counts."""
    counts = counts or class_counts(df, [label] if label else [])
    return hash_rank_totals(df, id_col, label, seed, salt).drop("_total"), counts


def hash_rank_totals(df: DataFrame, id_col: str, label: str | None, seed: int = 42, salt: str = "",
                     bits: int = FIXED_HASH_BITS) -> DataFrame:
    """Adds ``_rank`` (by md5(seed|salt|id), ties by id) and ``_total`` (class size).

    The bucket is a fixed ``bits``-bit md5 prefix, so no row count is needed
    up front: two passes over the input and one shuffle, nothing collected.
    """
    key = hash_key(id_col, seed, salt)
    d = df.withColumn("_key", key)
    out = rank_with_totals(d, [F.asc_nulls_last("_key"), F.asc_nulls_last(id_col)], hash_bucket(F.col("_key"), bits),
                           [label] if label else [])
    return out.drop("_key")


def hash_fold_ranks(df: DataFrame, id_col: str, fold_col: str, k: int, seed: int = 42, salt: str = "") -> DataFrame:
    """Adds ``_ranks``: for each fold the rank of :func:`hash_rank` among the rows outside it (null inside it)."""
    key = hash_key(id_col, seed, salt)
    bucket = F.coalesce(hash_bucket(key, FIXED_HASH_BITS), F.lit(1 << 62))
    return fold_ranks(df, F.coalesce(key, F.lit("~")), F.asc_nulls_last(id_col), bucket, fold_col, k)


def id_rank_totals(df: DataFrame, id_col: str, label: str | None,
                   rows_per_bucket: int = DEFAULT_ROWS_PER_BUCKET) -> DataFrame:
    """Adds ``_rank`` by id inside the class and ``_total`` (class size); nothing is collected."""
    return value_rank(df, id_col, [label] if label else [], rows_per_bucket)


def stratified_split(df: DataFrame, id_col: str, label: str, test_size: float = 0.2,
                     seed: int = 42, salt: str = "", out_col: str = "split",
                     bits: int = FIXED_HASH_BITS) -> DataFrame:
    """L1: adds ``split`` = 'test' for the first floor(n_c*t+0.5) rows of each
    class in md5(seed|id) order, 'train' otherwise."""
    if not 0.0 < test_size < 1.0:
        raise ValueError("test_size must be in (0, 1)")
    ranked = hash_rank_totals(df, id_col, label, seed, salt, bits)
    cut = F.floor(F.col("_total").cast("double") * F.lit(float(test_size)) + F.lit(0.5))
    return ranked.withColumn(out_col, F.when(F.col("_rank") <= cut, F.lit("test"))
                             .otherwise(F.lit("train"))).drop("_rank", "_total")


def train_test(df: DataFrame, id_col: str, label: str, test_size: float = 0.2,
               seed: int = 42, **kw) -> tuple[DataFrame, DataFrame]:
    """L1 as two DataFrames (train, test)."""
    s = stratified_split(df, id_col, label, test_size, seed, **kw)
    return (s.where(F.col("split") == "train").drop("split"),
            s.where(F.col("split") == "test").drop("split"))


def three_way_split(df: DataFrame, id_col: str, label: str, test_size: float = 0.2,
                    val_size: float = 0.2, seed: int = 42, bits: int = FIXED_HASH_BITS) -> DataFrame:
    """L2: test first; then validation = val/(1-test) of the rest, both stratified.

    The second split ranks by a differently salted key ('val|').
    """
    first = stratified_split(df, id_col, label, test_size, seed, "", "_s1", bits)
    rest = first.where(F.col("_s1") == "train").drop("_s1")
    second = stratified_split(rest, id_col, label, val_size / (1.0 - test_size), seed, "val|",
                              "_s2", bits)
    val = second.select(*df.columns, F.when(F.col("_s2") == "test", F.lit("validation"))
                        .otherwise(F.lit("train")).alias("split"))
    test = first.where(F.col("_s1") == "test").select(*df.columns, F.lit("test").alias("split"))
    return val.unionByName(test)


def stratified_kfold(df: DataFrame, id_col: str, label: str, k: int = 5, seed: int = 42,
                     shuffle: bool = True, fold_col: str = "fold",
                     rows_per_bucket: int = DEFAULT_ROWS_PER_BUCKET) -> DataFrame:
    """L3 (shuffle=True): fold = (rank - 1) % k, rank by md5(seed|id) in the class.
    L4 (shuffle=False): rank by id, fold = floor((rank - 1) * k / n_c)."""
    if k < 2:
        raise ValueError("k must be at least 2")
    if shuffle:
        bits = FIXED_HASH_BITS if rows_per_bucket == DEFAULT_ROWS_PER_BUCKET else min(
            FIXED_HASH_BITS, max(0, 20 - int(math.log2(max(rows_per_bucket, 1)))))
        ranked = hash_rank_totals(df, id_col, label, seed, "", bits).drop("_total")
        fold = ((F.col("_rank") - 1) % k).cast("int")
    else:
        ranked = id_rank_totals(df, id_col, label, rows_per_bucket)
        fold = F.floor((F.col("_rank") - 1) * k / F.col("_total")).cast("int")
    return ranked.withColumn(fold_col, fold).drop("_rank", "_total")


def tail_holdout(df: DataFrame, id_col: str, fraction: float = 0.2, out_col: str = "split",
                 rows_per_bucket: int = DEFAULT_ROWS_PER_BUCKET) -> DataFrame:
    """The last ``fraction`` of rows by id is 'validation' (no shuffle, no strata)."""
    ranked = id_rank_totals(df, id_col, None, rows_per_bucket)
    keep = F.floor(F.col("_total").cast("double") * F.lit(1.0 - fraction))
    return ranked.withColumn(out_col, F.when(F.col("_rank") > keep, F.lit("validation"))
                             .otherwise(F.lit("train"))).drop("_rank", "_total")


def head(df: DataFrame, k: int = 5, order_col: str = "id") -> DataFrame:
    """First ``k`` rows by an explicit key (TakeOrderedAndProject, bounded by k)."""
    return df.orderBy(order_col).limit(k)
