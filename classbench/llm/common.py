"""Helpers shared by the training-data operators (Spark expressions and scratch tables)."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from classbench.session import new_scratch_path

#: White space of the word definition used by every operator: words are ``[^\x20\x09-\x0D]+``.
SPACE_CLASS = r"\x20\x09-\x0D"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    Cuts lineage with a file every executor can read, so a lost executor costs
    a re-read and never a recomputation of what came before.
    """
    spark = df.sparkSession
    path = new_scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column of ``df`` bears it (case aside, as Spark compares names)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once for each row.

    Inside a lambda an outer expression is evaluated again for every element;
    a one-element ``transform`` binds it instead.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def long_array(values: Iterable[int]) -> Column:
    """Array literal of longs, folded to one constant by the optimizer."""
    values = list(values)
    if not values:
        return F.array().cast("array<bigint>")
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def plain_words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text, null as empty."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), f"[{SPACE_CLASS}]+"), lambda w: w != "")


def word_count(text: Column) -> Column:
    """Number of words without building them: white-space-to-word steps."""
    squeezed = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), f"[{SPACE_CLASS}]+", " "))
    return F.when(squeezed == "", F.lit(0)).otherwise(
        F.length(squeezed) - F.length(F.translate(squeezed, " ", "")) + 1).cast("long")


def hex64(value: Column) -> Column:
    """A long as 16 lower-case hex digits."""
    return F.lpad(F.lower(F.hex(value)), 16, "0")


#: Most cut points a range bucket may have; both search levels then stay at 128 comparisons.
MOST_CUTS = 128 * 128


def range_cuts(df: DataFrame, column: str, rows_per_bucket: int) -> list[int]:
    """Ascending distinct values of an integer column that end ranges of about equal size.

    Every cut is a value of the column and the last is its maximum.  At most
    :data:`MOST_CUTS`, whatever the table's size; beyond that ranges grow.
    """
    n = df.where(F.col(column).isNotNull()).count()
    if n == 0:
        return []
    parts = max(1, min(MOST_CUTS - 1, -(-n // rows_per_bucket)))
    row = df.agg(
        F.percentile_approx(column, [i / parts for i in range(1, parts)] or [1.0], max(10_000, 10 * parts)).alias("cuts"),
        F.max(column).alias("top")).first()
    return sorted({int(x) for x in (row["cuts"] if parts > 1 else [])} | {int(row["top"])})


def range_bucket(column: Column, cuts: list[int]) -> Column:
    """Index of the first cut that is not below the value (null: 0), by two search levels."""
    if len(cuts) < 2:
        return F.lit(0).cast("long")
    step = 128
    coarse = cuts[step - 1::step]
    below = lambda array: F.size(F.filter(array, lambda c: c < column))
    first = below(long_array(coarse)) if coarse else F.lit(0)
    found = let(first.cast("int"), lambda k: k * step + below(F.slice(long_array(cuts), k * step + 1, step)))
    return F.coalesce(found, F.lit(0)).cast("long")
