"""Nulls, NaN and unusual key types lose no row and change no figure."""

from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from classbench.models.network import EarlyStopping
from classbench.operators import encode, profile, split
from classbench.plans.prepare import label_column, prepare_table
from classbench.spec import table_spec

DAY = datetime.date(2024, 1, 1)


def test_splits_keep_null_ids_and_classes(spark):
    rows = [(None if i % 4 == 0 else i, None if i % 2 else DAY, f"k{i:03d}") for i in range(100)]
    df = spark.createDataFrame(rows, "id long, day date, key string")
    assert split.stratified_split(df, "id", "day").count() == 100
    assert split.stratified_split(df, "id", "day", bits=0).count() == 100
    assert split.stratified_kfold(df, "id", "day", 5).count() == 100
    for rows_per_bucket in (1000, 9):
        held = split.tail_holdout(df, "key", 0.2, rows_per_bucket=rows_per_bucket)
        assert {r.key for r in held.where("split = 'validation'").collect()} == {f"k{i:03d}" for i in range(80, 100)}
        held = split.tail_holdout(df, "id", 0.2, rows_per_bucket=rows_per_bucket)
        assert held.count() == 100 and held.where("split = 'validation' and id is not null").count() == 0
        folds = split.stratified_kfold(df, "key", None, 4, shuffle=False, rows_per_bucket=rows_per_bucket)
        assert [r.n for r in folds.groupBy("fold").agg(F.count("*").alias("n")).collect()] == [25] * 4


def test_profile_takes_nan_and_null_groups(spark):
    nan = float("nan")
    df = spark.createDataFrame([(1.0, "a"), (2.0, "a"), (3.0, None), (4.0, None), (nan, None), (None, "a")], "x double, g string")
    d = profile.describe(df, ["x"]).first()
    assert (d["count"], d["mean"], d["max"], d["q50"]) == (4, 2.5, 4.0, 2.5)
    assert profile.missing_total(df).first()[0] == 5
    assert {r["name"]: r["missing"] for r in profile.missing_by_column(df).collect()} == {"x": 2, "g": 3}
    h = profile.histogram(df, "x", 3).orderBy("bin").collect()
    assert [r["count"] for r in h] == [1, 1, 2]
    by = profile.histogram(df, "x", 3, "g")
    assert {r.g: r.n for r in by.groupBy("g").agg(F.sum("count").alias("n")).collect()} == {"a": 2, None: 2}
    assert {r.g: r.n for r in profile.box_summary(df, "x", ["g"]).collect()} == {"a": 2, None: 2}


def test_targets_and_roles(spark):
    df = spark.createDataFrame([(i, ["True", "False", None, "maybe"][i % 4], float(i), i % 3 == 0, DAY) for i in range(200)],
                               "id long, target string, x double, flag boolean, day date")
    labelled, names = label_column(df, "target")
    assert names == ["False", "True", "maybe"] and labelled.where("label is null").count() == 50
    two, names = label_column(df.where("target <> 'maybe' or target is null"), "target")
    assert names == ["False", "True"] and two.where("label is null").count() == 50
    assert set(table_spec(df).features) == {"x", "flag", "day"}
    with pytest.raises(ValueError):
        table_spec(df.withColumn("bad", F.array("x")))
    p = prepare_table(df)
    assert p.unlabelled == 50 and p.train.count() + p.test.count() == 150 and p.train.first().features.size == 3
    enc = encode.fit_label_encoding(df.where("target = 'True'"), ["target"], handle_invalid="keep")
    back = enc.inverse(enc.transform(df), "target").select("target").distinct().collect()
    assert {r.target for r in back} == {"True", None}


def test_callbacks_start_anew(spark):
    from pyspark.ml.linalg import Vectors

    from classbench.models.network import FeedForwardClassifier

    rows = [(Vectors.dense([i % 7, i % 5]), float(i % 2)) for i in range(120)]
    df = spark.createDataFrame(rows, ["features", "label"])
    net = FeedForwardClassifier([("dense", 4, "relu")], 2, epochs=3, early_stopping=EarlyStopping(patience=2))
    assert len(net.fit(df, df).history) == len(net.fit(df, df).history)
