import numpy as np
import pytest

from classbench.operators import encode


def test_label_encoding_alphabetical_with_null_category(spark):
    df = spark.createDataFrame([(1, "b"), (2, None), (3, "a"), (4, "b")], "id int, c string")
    enc = encode.fit_label_encoding(df, ["c"])
    got = {r["id"]: r["c"] for r in enc.transform(df).collect()}
    assert got == {1: 1, 2: 2, 3: 0, 4: 1}  # a < b < nan
    d = {(r["value"], r["code"]) for r in enc.dictionary(spark).collect()}
    assert d == {("a", 0), ("b", 1), ("nan", 2)}
    inv = enc.inverse(enc.transform(df), "c", "back").orderBy("id").collect()
    assert [r["back"] for r in inv] == ["b", "nan", "a", "b"]


def test_unseen_values_kept_when_fitted_on_train(spark):
    train = spark.createDataFrame([("x",), ("y",)], "c string")
    test = spark.createDataFrame([("z",)], "c string")
    enc = encode.fit_label_encoding(train, ["c"], handle_invalid="keep")
    assert enc.transform(test).first()["c"] == 2


def test_population_scaler(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0), (6.0, 5.0)], "a double, k double")
    sc = encode.fit_population_scaler(df, ["a", "k"])
    out = sc.transform(df).collect()
    a = np.array([1.0, 2.0, 3.0, 6.0])
    assert [r["a"] for r in out] == pytest.approx(list((a - a.mean()) / a.std()))
    assert all(r["k"] == 0.0 for r in out)


def test_target_encoding_and_assembly_names(spark):
    df = spark.createDataFrame([(True, 1.0, 2.0), (False, 3.0, 4.0)], "t boolean, x double, y double")
    out, names = encode.encode_target(df, "t")
    assert [r["t"] for r in out.collect()] == [1, 0] and names == [False, True]
    txt = spark.createDataFrame([("no",), ("yes",)], "t string")
    out2, names2 = encode.encode_target(txt, "t")
    assert [r["t"] for r in out2.collect()] == [0, 1] and names2 == ["no", "yes"]
    v = encode.assemble(df, ["y", "x"])
    assert encode.feature_names(v) == ["y", "x"]
