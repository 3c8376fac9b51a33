"""Readers and sinks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def read_csv(spark: SparkSession, path: str, schema: str | StructType | None = None,
             infer: bool = True) -> DataFrame:
    """CSV with a header row.

    With ``schema`` nothing is inferred (the production form); otherwise
    ``inferSchema`` samples the file (an extra pass), as the reference's
    loader does.  'True'/'False' text is read as boolean, blanks as null.
    """
    r = spark.read.option("header", True)
    if schema is not None:
        return r.schema(schema).csv(path)
    return r.option("inferSchema", infer).csv(path)


def read_first(spark: SparkSession, loaders: list[tuple[str, Callable[[], DataFrame]]]
               ) -> tuple[DataFrame, str]:
    """The first loader whose schema resolves, and its name.

    The name of the source actually used is returned (no silent switch,
    SURVEY Q13); raises when none resolves.
    """
    errors = []
    for name, load in loaders:
        try:
            df = load()
            _ = df.schema  # resolves paths and the schema, reads no rows
            return df, name
        except Exception as exc:  # noqa: BLE001 - any load failure moves on
            errors.append(f"{name}: {type(exc).__name__}: {str(exc)[:200]}")
    raise FileNotFoundError("no source could be loaded:\n" + "\n".join(errors))


def transpose_one_row(df: DataFrame) -> DataFrame:
    """(field, Value) text rows from a one-row frame (S5's transposition)."""
    cols = df.columns
    return df.select(*[F.col(c).cast("string").alias(c) for c in cols]).unpivot(
        [], cols, "field", "Value")


REPORT_SCHEMA = StructType([StructField("field", StringType()), StructField("Value", StringType())])


def report_sink(summary: DataFrame, path: str) -> DataFrame:
    """Write the transposed one-row summary as CSV with a header; return what was written."""
    transpose_one_row(summary).coalesce(1).write.option("header", True).csv(path)
    return summary.sparkSession.read.option("header", True).schema(REPORT_SCHEMA).csv(path)


def artifacts(spark: SparkSession, items: dict[str, str]) -> DataFrame:
    """(artifact, path) table of what a run wrote."""
    schema = StructType([StructField("artifact", StringType()), StructField("path", StringType())])
    return spark.createDataFrame(sorted(items.items()), schema)
