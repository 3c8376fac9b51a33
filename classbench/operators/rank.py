"""Exact ranks at scale.

A rank within a class must not come from a window partitioned by the class
alone: a binary label puts half the table (or a hot class a third of it) in
one task.  Instead rows get a *bucket* that is a pure, monotone function of
the sort key, so that

    rank = (rows of the same class in earlier buckets) + row_number in (class, bucket).

The first term comes from a small table of counts per (class, bucket) whose
prefix sums are joined back (Spark picks the join by its size).  The bucket count grows with the data, so every
(class, bucket) window holds about ``rows_per_bucket`` rows.  Buckets are
functions of the row, not of partition ids, so a recomputed task after an
executor loss yields the same ranks; ranges of ids, which Spark samples, are
written with the row's place before they are counted.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from classbench.session import written

DEFAULT_ROWS_PER_BUCKET = 1 << 20


def hash_key(id_col: str, seed: int = 42, salt: str = "") -> Column:
    """Shuffle key: md5 of '<seed>|<salt><id>' as hex text (same text in DuckDB)."""
    return F.md5(F.concat(F.lit(f"{seed}|{salt}"), F.col(id_col).cast("string")))


def hash_bucket(key: Column, bits: int) -> Column:
    """Leading ``bits`` bits of a hex md5 key; monotone in the key's text order."""
    if bits <= 0:
        return F.lit(0).cast("long")
    top32 = F.conv(F.substring(key, 1, 8), 16, 10).cast("long")
    return F.shiftright(top32, 32 - bits)


def class_counts(df: DataFrame, partition_cols: list[str]) -> list[tuple]:
    """Row count per class (bounded by the number of classes)."""
    if not partition_cols:
        return [((), df.count())]
    rows = df.groupBy(*partition_cols).agg(F.count(F.lit(1)).alias("_n")).collect()
    if len(rows) > 100_000:
        raise ValueError("too many classes for a stratified operation")
    return [(tuple(r[c] for c in partition_cols), r["_n"]) for r in rows]


def value_bucket(df: DataFrame, col: str, n_buckets: int) -> tuple[DataFrame, Column]:
    """Monotone bucket of a numeric column from approximate cut points.

    Cut points only balance the buckets; exactness never depends on them
    because the bucket is a monotone function of the value.
    """
    if n_buckets <= 1:
        return df, F.lit(0).cast("long")
    probs = [i / n_buckets for i in range(1, n_buckets)]
    cuts = df.agg(F.percentile_approx(F.col(col).cast("double"), probs, 10 * n_buckets)).first()[0]
    splits = [-math.inf] + sorted(set(float(c) for c in cuts if c is not None)) + [math.inf]
    tmp = "_vb_in"
    d = df.withColumn(tmp, F.col(col).cast("double"))
    d = Bucketizer(splits=splits, inputCol=tmp, outputCol="_vb_out",
                   handleInvalid="keep").transform(d).drop(tmp)
    return d.withColumnRenamed("_vb_out", "_vb"), F.col("_vb").cast("long")


FIXED_HASH_BITS = 20


def _null_safe_key(col: str) -> list[Column]:
    """Two non-null expressions that identify a (possibly null) class value of any type."""
    return [F.coalesce(F.col(col).cast("string"), F.lit("")), F.col(col).isNull()]


def rank_with_totals(df: DataFrame, order_cols: list[Column], bucket: Column,
                     partition_cols: list[str] = (), rank_col: str = "_rank",
                     total_col: str = "_total") -> DataFrame:
    """Exact 1-based rank within ``partition_cols`` (``order_cols`` with nulls last) plus the partition's row count,
    with no driver round trip.

    Pass 1 counts rows per (class, bucket) (partial aggregation); prefix sums
    and class totals come from windows over that small table.  Pass 2 joins
    them back and numbers rows inside (class, bucket).  The join and the
    window use the same key expressions, so the data is shuffled once.
    """
    part = list(partition_cols)
    keys = [k for c in part for k in _null_safe_key(c)]
    names = [f"_k{i}" for i in range(len(keys))]
    # a null key ranks last: in the bucket after all others, as nulls last orders it within one
    d = df.select("*", *[k.alias(n) for k, n in zip(keys, names)], F.coalesce(bucket, F.lit(1 << 62)).alias("_bk"))
    counts = d.groupBy(*names, "_bk").agg(F.count(F.lit(1)).alias("_cnt"))
    before = Window.partitionBy(*names).orderBy("_bk")
    whole = Window.partitionBy(*names)
    offs = counts.select(*names, "_bk", (F.sum("_cnt").over(before) - F.col("_cnt")).alias("_off"),
                         F.sum("_cnt").over(whole).alias(total_col))
    j = d.join(offs, names + ["_bk"])
    rn = F.row_number().over(Window.partitionBy(*names, "_bk").orderBy(*order_cols))
    return j.withColumn(rank_col, (F.col("_off") + rn).cast("long")).drop(*names, "_bk", "_off")


def ranges_for(df: DataFrame, rows_per_range: int = DEFAULT_ROWS_PER_BUCKET) -> int:
    """Ranges of about ``rows_per_range`` rows that a table needs (a row count reads no column)."""
    return max(1, math.ceil(df.count() / rows_per_range))


def ranged_rank(df: DataFrame, order_cols: list[str], ranges: int, partition_cols: list[str] = (),
                rank_col: str = "_rank", total_col: str = "_total") -> DataFrame:
    """:func:`rank_with_totals` for keys of any ordered type and any number of ranges.

    Rows are dealt by ranges of (class, key, hash of the row) that Spark samples,
    sorted inside each and written with their place in it, so that ranks stay
    the same whichever executor is lost later.  A class's rows in a range are
    contiguous: its rank is the place there plus the rows in lower ranges, one
    row for each (class, range).  Nulls come last; equal keys, nulls among
    them, are ordered by the hash, so a key that many rows share is cut too.
    """
    part = list(partition_cols)
    keys = [k for c in part for k in _null_safe_key(c)]
    names = [f"_k{i}" for i in range(len(keys))]
    hashed = [f.name for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    keyed = df.select("*", *[k.alias(n) for k, n in zip(keys, names)], F.xxhash64(*hashed).alias("_tie"))
    order = [*names, *[F.asc_nulls_last(c) for c in order_cols], "_tie"]
    place = F.monotonically_increasing_id()  # partition number above 33 bits, place in the partition below
    dealt = keyed.repartitionByRange(ranges, *order).sortWithinPartitions(*order).withColumn("_place", place)
    rows = written(dealt.drop("_tie"), "ranges").withColumn("_range", F.shiftright("_place", 33))
    held = rows.groupBy(*names, "_range").agg(F.count(F.lit(1)).alias("_n"), F.min("_place").alias("_first"))
    whole = Window.partitionBy(*names)
    before = whole.orderBy("_range")
    offsets = written(held.select(*names, "_range", (F.sum("_n").over(before) - F.col("_n") - F.col("_first") + 1).alias("_off"),
                                  F.sum("_n").over(whole).alias(total_col)), "offsets")
    out = rows.join(offsets, names + ["_range"])
    return out.withColumn(rank_col, F.col("_off") + F.col("_place")).drop(*names, "_range", "_place", "_off")


def value_rank(df: DataFrame, col: str, partition_cols: list[str] = (),
               rows_per_bucket: int = DEFAULT_ROWS_PER_BUCKET) -> DataFrame:
    """Adds ``_rank`` by a key of any ordered type (nulls last) inside the class, and ``_total``, the class size.

    A table of one bucket is numbered in a window, a larger one by ranges.
    """
    ranges = ranges_for(df, rows_per_bucket)
    if ranges == 1:
        return rank_with_totals(df, [F.asc_nulls_last(col)], F.lit(0).cast("long"), partition_cols)
    return ranged_rank(df, [col], ranges, partition_cols)


def fold_ranks(df: DataFrame, key: Column, ties: Column, bucket: Column, fold_col: str, k: int,
               out_col: str = "_ranks") -> DataFrame:
    """Adds an array of the row's rank, by ``key``, among the rows outside each fold: one ranking for all folds.

    The rank outside fold f is the rank in the whole table less the rows of f
    before it; both are sums over earlier buckets, from one small table of
    counts per bucket, plus running counts in the row's own bucket.
    """
    d = df.select("*", key.alias("_key"), bucket.alias("_bk"))
    counts = [F.count_if(~F.col(fold_col).eqNullSafe(F.lit(f))).alias(f"_o{f}") for f in range(k)]
    earlier = Window.orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1)
    sums = d.groupBy("_bk").agg(*counts).select(
        "_bk", F.array(*[F.coalesce(F.sum(f"_o{f}").over(earlier), F.lit(0)) for f in range(k)]).alias("_off"))
    inside = Window.partitionBy("_bk").orderBy("_key", ties).rowsBetween(Window.unboundedPreceding, 0)
    ranks = [F.when(~F.col(fold_col).eqNullSafe(F.lit(f)),
                    F.col("_off")[f] + F.count_if(~F.col(fold_col).eqNullSafe(F.lit(f))).over(inside)) for f in range(k)]
    return d.join(sums, "_bk").withColumn(out_col, F.array(*ranks)).drop("_key", "_bk", "_off")
