"""Generic table preparation: what the reference loaders do for any CSV.

load (S1, S4) -> roles from the schema (S3, P5) -> target to 0/1 or codes
(P2, P3, E3) -> label codes for text features with null as 'nan' (E1, E2) ->
optional population scaling fitted on the training part (E6) -> assembled
``features`` (E5).  The output always has ``id``, ``features``, ``label``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType

from classbench.operators import encode, split
from classbench.session import written
from classbench.spec import TableSpec, table_spec


@dataclass
class Prepared:
    """Prepared parts and what was learned while preparing them."""

    train: DataFrame
    test: DataFrame
    spec: TableSpec
    feature_names: list[str]
    class_names: list | None
    encoding: object | None
    scaler: object | None
    unlabelled: int = 0  # rows without a target, which neither part holds


#: Equal rows that one task numbers.
COPIES_PER_TASK = 1 << 16


def with_row_id(df: DataFrame, id_col: str = "id") -> DataFrame:
    """A row key for tables without one (CSV files): md5 of all columns and an ordinal among equal rows.

    The key comes from what a row holds, so it does not depend on how files are
    cut or read.  Equal rows are counted, partially before they are shuffled,
    and made again with ordinals from 0; the copies of a row that has many
    are made in blocks by several tasks.
    """
    if id_col in df.columns:
        return df
    columns = [F.col(f"`{c}`") for c in df.columns]
    text = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
    counted = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_copies")).withColumn("_md5", F.md5(text))
    block = F.sequence(F.lit(0).cast("long"), F.floor((F.col("_copies") - 1) / COPIES_PER_TASK))
    few, many = F.col("_copies") <= COPIES_PER_TASK, F.col("_copies") > COPIES_PER_TASK
    counted = written(counted, "rows")
    blocks = counted.where(few).withColumn("_block", F.lit(0).cast("long")).unionByName(
        counted.where(many).withColumn("_block", F.explode(block)).repartition("_md5", "_block"))
    first = F.col("_block") * COPIES_PER_TASK
    ordinals = F.sequence(first, F.least(first + COPIES_PER_TASK, F.col("_copies")) - 1)
    rows = blocks.withColumn("_ordinal", F.explode(ordinals))
    return rows.select(*columns, F.concat_ws("-", "_md5", "_ordinal").alias(id_col))


def label_column(df: DataFrame, target: str) -> tuple[DataFrame, list | None]:
    """Boolean -> 0/1; 'True'/'False' text -> 1/0 (other text null);
    other text -> alphabetical codes; numbers pass.  A null target has no label."""
    dt = df.schema[target].dataType
    if isinstance(dt, BooleanType):
        return df.withColumn("label", F.col(target).cast("int")), [False, True]
    if isinstance(dt, StringType):
        known = df.agg(F.bool_and(F.col(target).isin("True", "False")).alias("b")).first()["b"]  # all values, nulls aside
        if known:
            lab = F.when(F.col(target) == "True", 1).when(F.col(target) == "False", 0)
            return df.withColumn("label", lab.cast("int")), ["False", "True"]
        coded, names = encode.encode_target(df, target)
        return coded.withColumn("label", F.col(target)), names
    return df.withColumn("label", F.col(target).cast("int")), None


def prepare_table(df: DataFrame, target: str | None = None, id_col: str = "id",
                  categorical: list[str] | None = None, test_size: float = 0.2, seed: int = 42,
                  scale: bool = False, fit_encoding_on: str = "all") -> Prepared:
    """Split a table into prepared train/test parts (exact stratified split, L1).

    ``fit_encoding_on='all'`` fits the label codes on every row, as the
    reference does (Q1); ``'train'`` fits on the training part and gives
    unseen values an extra code.
    """
    df = with_row_id(df, id_col)
    ts = table_spec(df, id_col, target, categorical)
    labelled, class_names = label_column(df, ts.target)
    unlabelled = labelled.where(F.col("label").isNull()).count()
    labelled = labelled.where(F.col("label").isNotNull())
    parts = split.stratified_split(labelled, id_col, "label", test_size, seed)
    parts = parts.persist()
    train = parts.where(F.col("split") == "train")
    test = parts.where(F.col("split") == "test")
    enc = None
    if ts.categorical:
        fit_df = labelled if fit_encoding_on == "all" else train
        enc = encode.fit_label_encoding(fit_df, list(ts.categorical),
                                        handle_invalid="error" if fit_encoding_on == "all" else "keep")
        train, test = enc.transform(train), enc.transform(test)
    names = list(ts.categorical) + list(ts.numeric)
    scaler = None
    if scale:
        scaler = encode.fit_population_scaler(train, names)
        train, test = scaler.transform(train), scaler.transform(test)
    out = []
    for part in (train, test):
        d = part.select(id_col, *[F.col(c).cast("double").alias(c) for c in names], "label")
        out.append(encode.assemble(d, names).select(F.col(id_col).alias("id"), "features",
                                                      F.col("label").cast("double").alias("label")))
    return Prepared(out[0], out[1], ts, names, class_names, enc, scaler, unlabelled)
