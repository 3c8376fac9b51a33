"""Encoding and scaling.

A label encoding is a table (name, value, code): the distinct values of all
columns, ranked within their column by the two-level rank of ``rank``, so
neither the values nor their order pass through the driver or one task.
Columns are coded by joins with that table; Spark broadcasts its small parts
and splits hot values of large ones.  Standard scaling uses the population
standard deviation, fitted with one aggregate and applied as column arithmetic
(stays in codegen).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from classbench.operators.rank import value_rank
from classbench.session import scratch_dir

NULL_TOKEN = "nan"


def as_category(df: DataFrame, cols: list[str]) -> DataFrame:
    """Cast to text and make null its own category 'nan'."""
    return df.select(*[F.coalesce(F.col(c).cast("string"), F.lit(NULL_TOKEN)).alias(c)
                       if c in cols else F.col(c) for c in df.columns])


@dataclass
class LabelEncoding:
    """A fitted label encoding of several columns.

    ``vocabulary`` holds (name, value, code); ``unseen`` the code of values it
    lacks for each column, or nothing where they are an error.
    """

    vocabulary: DataFrame
    columns: list[str]
    suffix: str
    unseen: dict[str, int] | None = None

    def _codes(self, column: str, value: str, code: str) -> DataFrame:
        return self.vocabulary.where(F.col("name") == column).select(
            F.col("value").alias(value), F.col("code").cast("int").alias(code))

    def transform(self, df: DataFrame, replace: bool = True) -> DataFrame:
        """Codes as integer columns; ``replace`` keeps the original names."""
        out = as_category(df, self.columns)
        for c in self.columns:
            key, code = "_value" + self.suffix, c + self.suffix
            found = out.join(self._codes(c, key, code), F.col(c) == F.col(key), "left").drop(key)
            if self.unseen is None:
                missing = F.raise_error(F.concat(F.lit(f"value of {c} not seen in fitting: "), F.col(c))).cast("int")
            else:
                missing = F.lit(self.unseen[c])
            out = found.withColumn(code, F.coalesce(F.col(code), missing))
            if replace:
                out = out.drop(c).withColumnRenamed(code, c)
        return out.select(*df.columns) if replace else out

    def dictionary(self, spark) -> DataFrame:
        """(name, value, code)."""
        return self.vocabulary.select("name", "value", "code")

    def inverse(self, df: DataFrame, col: str, out_col: str | None = None) -> DataFrame:
        """Codes back to values by a join; a null code and that of unseen values give null."""
        target = out_col or col
        labels = self._codes(col, "_label", "_code")
        found = df.join(labels, F.col(col).cast("int") == F.col("_code"), "left").withColumn(target, F.col("_label"))
        return found.drop("_label", "_code")


def fit_label_encoding(df: DataFrame, cols: list[str], suffix: str = "__code",
                       handle_invalid: str = "error") -> LabelEncoding:
    """Alphabetical codes from 0 for each column, as a table in the checkpoint folder.

    ``handle_invalid='keep'`` gives unseen values an extra code, the number of
    known ones (fit on the training part only, SURVEY Q1 option).
    """
    scratch_dir(df.sparkSession)
    long = as_category(df.select(*cols), cols).unpivot([], cols, "name", "value")
    values = long.distinct().checkpoint()
    ranked = value_rank(values, "value", ["name"])
    vocabulary = ranked.select("name", "value", (F.col("_rank") - 1).alias("code")).checkpoint()
    unseen = None
    if handle_invalid == "keep":  # one number for each column
        sizes = {r["name"]: r["n"] for r in vocabulary.groupBy("name").agg(F.count("*").alias("n")).collect()}
        unseen = {c: sizes.get(c, 0) for c in cols}
    return LabelEncoding(vocabulary, list(cols), suffix, unseen)


def encode_target(df: DataFrame, target: str) -> tuple[DataFrame, list]:
    """Booleans map false/true to 0/1, numbers pass, text gets E1 codes; null stays null.

    Returns the frame with the integer target and the class names by code (as
    many as there are classes).
    """
    dt = df.schema[target].dataType
    if isinstance(dt, StringType):
        enc = fit_label_encoding(df.where(F.col(target).isNotNull()), [target], handle_invalid="keep")
        coded = enc.transform(df.withColumn("_no_target", F.col(target).isNull()))
        known = F.when(~F.col("_no_target"), F.col(target))
        return coded.withColumn(target, known).drop("_no_target"), [r["value"] for r in enc.dictionary(df.sparkSession).orderBy("code").collect()]
    if dt.simpleString() == "boolean":
        return df.withColumn(target, F.col(target).cast("int")), [False, True]
    return df.withColumn(target, F.col(target).cast("int")), None


def assemble(df: DataFrame, cols: list[str], out_col: str = "features",
             handle_invalid: str = "error") -> DataFrame:
    """E5: ``VectorAssembler``; the feature names stay in the column metadata."""
    return VectorAssembler(inputCols=cols, outputCol=out_col,
                           handleInvalid=handle_invalid).transform(df)


def feature_names(df: DataFrame, col: str = "features") -> list[str]:
    """Names of the assembled features, in order, from the vector metadata."""
    meta = df.schema[col].metadata.get("ml_attr", {})
    attrs = []
    for group in meta.get("attrs", {}).values():
        attrs += group
    return [a["name"] for a in sorted(attrs, key=lambda a: a["idx"])]


@dataclass
class PopulationScaler:
    """E6 model: (x - mean) / population std; a constant column maps to 0."""

    columns: list[str]
    means: list[float]
    stds: list[float]

    def transform(self, df: DataFrame, suffix: str = "") -> DataFrame:
        out = df
        for c, m, s in zip(self.columns, self.means, self.stds):
            x = F.col(c).cast("double") - F.lit(m)
            scaled = x / F.lit(s) if s and s > 0 else x * F.lit(0.0)
            out = out.withColumn(c + suffix, scaled)
        return out


def fit_population_scaler(df: DataFrame, cols: list[str]) -> PopulationScaler:
    """Fit on one DataFrame (the training part) with a single aggregate."""
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        aggs += [F.avg(x).alias(f"m{i}"), F.stddev_pop(x).alias(f"s{i}")]
    r = df.agg(*aggs).first()
    return PopulationScaler(list(cols), [r[f"m{i}"] for i in range(len(cols))],
                            [r[f"s{i}"] for i in range(len(cols))])
