"""Profiling.

Scalar statistics are computed in one aggregate pass and unpivoted; grouped
ones are ``groupBy`` with map-side partial aggregation, so a hot value (a
class holding a third of all rows) is combined per task before the shuffle.
Only results bounded by columns, classes or bins reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, DoubleType, FloatType, LongType, NumericType, StringType,
                               StructField, StructType)

from classbench.operators.quantile import exact_quantiles_many, grouped_quantiles
from classbench.spec import numeric_columns


def shape(df: DataFrame) -> DataFrame:
    """A1: one row (n_rows, n_columns)."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows", F.lit(len(df.columns)).alias("n_columns"))


def _map_literal(d: dict) -> F.Column:
    kv = []
    for k, v in d.items():
        kv += [F.lit(k), F.lit(v)]
    return F.create_map(*kv)


def schema_profile(df: DataFrame) -> DataFrame:
    """A2: (position, name, dtype, non_null) in one aggregate pass."""
    cols = df.columns
    wide = df.agg(*[F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(cols)])
    long = wide.unpivot([], [f"c{i}" for i in range(len(cols))], "k", "non_null")
    pos = F.expr("CAST(substring(k, 2) AS INT)")
    names = _map_literal({i: c for i, c in enumerate(cols)})
    types = _map_literal({i: f.dataType.simpleString() for i, f in enumerate(df.schema.fields)})
    return long.select(pos.alias("position"), names[pos].alias("name"),
                       types[pos].alias("dtype"), F.col("non_null").cast("long").alias("non_null"))


def known(df: DataFrame, col: str) -> F.Column:
    """A column with NaN, which is missing too, as null."""
    value = F.col(f"`{col}`")
    if isinstance(df.schema[col].dataType, (DoubleType, FloatType)):
        return F.when(~F.isnan(value), value)
    return value


def _null_counts(df: DataFrame) -> DataFrame:
    return df.agg(*[F.count_if(known(df, c).isNull()).alias(f"c{i}") for i, c in enumerate(df.columns)])


def missing_total(df: DataFrame) -> DataFrame:
    """A3: total number of null cells."""
    wide = _null_counts(df)
    total = sum((F.col(c) for c in wide.columns), F.lit(0).cast("long"))
    return wide.select(total.cast("long").alias("missing"))


def missing_by_column(df: DataFrame) -> DataFrame:
    """A4: (position, name, missing), same single pass as A3."""
    cols = df.columns
    long = _null_counts(df).unpivot([], [f"c{i}" for i in range(len(cols))], "k", "missing")
    pos = F.expr("CAST(substring(k, 2) AS INT)")
    names = _map_literal({i: c for i, c in enumerate(cols)})
    return long.select(pos.alias("position"), names[pos].alias("name"),
                       F.col("missing").cast("long").alias("missing"))


def value_counts(df: DataFrame, col: str, order: str = "count") -> DataFrame:
    """(value, count) of non-null values.

    ``order='count'``: count descending, ties by value (A5);
    ``order='value'``: ascending value (A6, class order).
    """
    counts = (df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("value"))
              .agg(F.count(F.lit(1)).alias("count")))
    if order == "count":
        return counts.orderBy(F.desc("count"), F.asc("value"))
    return counts.orderBy("value")


def class_share(df: DataFrame, col: str, decimals: int = 1) -> DataFrame:
    """(value, count, percent) with percent rounded to ``decimals``.

    The total is one number from a separate aggregate, used as a literal: no
    cross join and no window, so a column with many distinct values is never
    pulled into one task.
    """
    nn = df.where(F.col(col).isNotNull())
    total = nn.agg(F.count(F.lit(1))).first()[0]
    counts = nn.groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("count"))
    return counts.select("value", "count",
                         F.round(F.col("count") * 100.0 / F.lit(max(total, 1)).cast("double"),
                                 decimals).alias("percent"))


def positive_rate(df: DataFrame, target: str | None) -> DataFrame:
    """Positive-class rate in percent over all rows; 0 when there is no target."""
    if target is None or target not in df.columns:
        return df.agg(F.lit(0.0).alias("positive_rate"))
    pos = F.sum(F.col(target).cast("int"))
    return df.agg((F.coalesce(pos, F.lit(0)) * 100.0 / F.count(F.lit(1))).alias("positive_rate"))


def distinct_classes(df: DataFrame, col: str, approx: bool = False) -> DataFrame:
    """Number of distinct non-null classes (HyperLogLog++ when ``approx``)."""
    f = F.approx_count_distinct(col) if approx else F.count_distinct(col)
    return df.agg(f.cast("long").alias("n_classes"))


DESCRIBE_SCHEMA = StructType([
    StructField("name", StringType()), StructField("count", LongType()),
    StructField("mean", DoubleType()), StructField("std", DoubleType()),
    StructField("min", DoubleType()), StructField("q25", DoubleType()),
    StructField("q50", DoubleType()), StructField("q75", DoubleType()),
    StructField("max", DoubleType())])


def describe(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """A10: count, mean, sample std, min, 25/50/75 % (linear), max per numeric column.

    Moments come from one aggregate; quantiles are exact order statistics
    from bracketing approximate quantiles (``operators.quantile``): three
    passes for all columns together, never a one-task sort.
    The result has one row per column.
    """
    if cols is None:
        cols = numeric_columns(df.schema)
    spark = df.sparkSession
    if not cols:
        return spark.createDataFrame([], DESCRIBE_SCHEMA)
    df = df.select(*[known(df, c).alias(c) for c in cols])
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(f"`{c}`").cast("double")
        aggs += [F.count(x).alias(f"d_n{i}"), F.avg(x).alias(f"d_m{i}"), F.stddev_samp(x).alias(f"d_s{i}"),
                 F.min(x).alias(f"d_lo{i}"), F.max(x).alias(f"d_hi{i}")]
    n_max = df.count()
    qs, mom = exact_quantiles_many(df, cols, [0.25, 0.5, 0.75], n_max=n_max, extra=aggs,
                                   return_row=True)
    rows = []
    for i, c in enumerate(cols):
        q = qs[c]
        rows.append((c, mom[f"d_n{i}"], mom[f"d_m{i}"], mom[f"d_s{i}"], mom[f"d_lo{i}"], q[0], q[1], q[2],
                     mom[f"d_hi{i}"]))
    return spark.createDataFrame(rows, DESCRIBE_SCHEMA)


def width_gate(df: DataFrame, target: str, stats_max: int = 20, sample_over: int = 50,
               sample_k: int = 10) -> dict:
    """Schema-level display decisions (no data scan).

    Statistics only for tables of at most ``stats_max`` columns; tables wider
    than ``sample_over`` show the target plus the first ``sample_k`` columns.
    """
    ncol = len(df.columns)
    sample = [target] + df.columns[:sample_k] if ncol > sample_over else list(df.columns)
    return {"n_columns": ncol, "show_stats": ncol <= stats_max, "sample_columns": sample}


def _edges(df: DataFrame, col: str, group: str | None = None, max_groups: int = 10_000):
    """(lo, hi, groups); at most ``max_groups`` groups reach the driver."""
    x = known(df, col).cast("double")
    r = df.agg(F.min(x).alias("lo"), F.max(x).alias("hi")).first()
    groups = None
    if group:
        found = [g[0] for g in df.select(group).distinct().limit(max_groups + 2).collect()]
        groups = sorted(g for g in found if g is not None)
        if len(groups) > max_groups:
            raise ValueError("too many groups for a grouped histogram")
        if len(found) > len(groups):
            groups.append(None)
    if r["lo"] is None:
        return None, None, groups
    lo, hi = r["lo"], r["hi"]
    if lo == hi:  # a single value: unit-wide range around it, as NumPy does
        lo, hi = lo - 0.5, hi + 0.5
    return lo, hi, groups


def histogram(df: DataFrame, col: str, bins: int = 30, group: str | None = None,
              lo: float | None = None, hi: float | None = None) -> DataFrame:
    """Equal-width histogram, last bin closed; empty bins kept.

    Output (``group``,) bin (1-based), lo, hi, count.  With ``group`` every
    group shares the same edges (A13).  Edges come from one min/max pass
    unless given.  The full (group, bin) grid is generated per group with
    ``explode(sequence)`` from the groups, collected with a bound,
    then left-joined to the counts; both sides are bounded by groups x bins.
    """
    groups = None
    if lo is None or hi is None or group:
        e_lo, e_hi, groups = _edges(df, col, group)
        if lo is None or hi is None:
            lo, hi = (0.0, 1.0) if e_lo is None else (e_lo, e_hi)
    width = (hi - lo) / bins
    x = known(df, col).cast("double")
    b = F.least(F.lit(bins), F.floor((x - F.lit(lo)) / F.lit(hi - lo) * F.lit(bins)).cast("int") + 1)
    keys = [group] if group else []
    inside = df.where(x.isNotNull() & (x >= F.lit(lo)) & (x <= F.lit(hi)))
    counts = inside.groupBy(*keys, b.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    if group:
        gtype = df.schema[group].dataType
        glits = F.array(*[F.lit(g).cast(gtype) for g in groups]) if groups else F.array().cast(
            f"array<{gtype.simpleString()}>")
        grid = (df.sparkSession.range(1).select(F.explode(glits).alias(group))
                .select(group, F.explode(F.sequence(F.lit(1), F.lit(bins))).alias("bin")))
    else:
        grid = df.sparkSession.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
    counts = counts.select(*[F.col(k).alias("_group") for k in keys], F.col("bin").alias("_bin"), "count")
    same = F.col("bin") == F.col("_bin")
    if group:
        same = same & F.col(group).eqNullSafe(F.col("_group"))
    out = grid.join(counts, same, "left")
    return out.select(*keys, "bin",
                      (F.lit(lo) + (F.col("bin") - 1) * F.lit(width)).alias("lo"),
                      (F.lit(lo) + F.col("bin") * F.lit(width)).alias("hi"),
                      F.coalesce(F.col("count"), F.lit(0)).cast("long").alias("count"))


def _group_quartiles(df: DataFrame, value: str, groups: list[str]) -> DataFrame:
    """(groups..., n, q1, median, q3), exact (linear interpolation)."""
    q = grouped_quantiles(df, value, groups, [0.25, 0.5, 0.75])
    return q.select(*groups, "n", *[F.col("q")[i].alias(name) for i, name in enumerate(("q1", "median", "q3"))])


def _join_groups(df: DataFrame, per_group: DataFrame, groups: list[str]) -> DataFrame:
    """Rows with their group's figures; a null group is a group.  Spark broadcasts the figures if they are small."""
    right = per_group.select(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(groups)],
                             *[c for c in per_group.columns if c not in groups])
    same = F.lit(True)
    for i, g in enumerate(groups):
        same = same & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    return df.join(right, same).drop(*[f"_g{i}" for i in range(len(groups))])


def box_summary(df: DataFrame, value: str, groups: list[str]) -> DataFrame:
    """Box-plot summary per group: q1, median, q3, whiskers, outlier count.

    Whiskers are the most extreme values within 1.5 IQR of the box.
    Quartiles are exact (``_group_quartiles``); the whiskers come from one
    join of the (bounded) quartile table back to the rows.
    """
    df = df.withColumn(value, known(df, value))
    q = _group_quartiles(df, value, groups)
    iqr = F.col("q3") - F.col("q1")
    j = _join_groups(df, q, groups).withColumn("lo_fence", F.col("q1") - 1.5 * iqr).withColumn(
        "hi_fence", F.col("q3") + 1.5 * iqr)
    v = F.col(value)
    inside = (v >= F.col("lo_fence")) & (v <= F.col("hi_fence"))
    return j.groupBy(*groups, "n", "q1", "median", "q3").agg(
        F.min(F.when(inside, v)).alias("whisker_lo"),
        F.max(F.when(inside, v)).alias("whisker_hi"),
        F.count_if(~inside).cast("long").alias("n_outliers"))


def box_outliers(df: DataFrame, value: str, groups: list[str]) -> DataFrame:
    """The rows beyond 1.5 IQR, with their group."""
    df = df.withColumn(value, known(df, value))
    s = box_summary(df, value, groups)
    iqr = F.col("q3") - F.col("q1")
    return (_join_groups(df, s, groups)
            .where((F.col(value) < F.col("q1") - 1.5 * iqr) | (F.col(value) > F.col("q3") + 1.5 * iqr))
            .select(*groups, value))
