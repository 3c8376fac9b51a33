import math

from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, StringType

from classbench.functions import scalar as S


def test_target_lookup_text_bool_numeric(spark):
    df = spark.createDataFrame([("True",), ("False",), ("yes",), (None,)], "t string")
    got = [r[0] for r in df.select(S.target_to_int("t", StringType())).collect()]
    assert got == [1, 0, None, None]
    b = spark.createDataFrame([(True,), (False,), (None,)], "t boolean")
    assert [r[0] for r in b.select(S.target_to_int("t", BooleanType())).collect()] == [1, 0, None]
    n = spark.createDataFrame([(3,)], "t int")
    assert n.select(S.target_to_int("t", IntegerType())).first()[0] == 3


def test_argmax_first_wins_and_threshold_strict(spark):
    df = spark.createDataFrame([([0.2, 0.4, 0.4],), ([1.0],)], "a array<double>")
    assert [r[0] for r in df.select(S.argmax("a")).collect()] == [1, 0]
    p = spark.createDataFrame([(0.5,), (0.500001,)], "p double")
    assert [r[0] for r in p.select(S.threshold("p")).collect()] == [0, 1]


def test_reshape_flatten_expand_one_hot(spark):
    df = spark.createDataFrame([(list(range(9)),), (list(range(8)),)], "a array<int>")
    rows = df.select(S.reshape_square("a", 9).alias("m")).collect()
    assert rows[0]["m"] == [[0, 1, 2], [3, 4, 5], [6, 7, 8]]
    assert rows[1]["m"] is None
    flat = df.limit(1).select(S.flatten_image(S.reshape_square("a", 9))).first()[0]
    assert flat == list(range(9))
    cols = df.limit(1).select(*S.expand_array("a", 3)).first()
    assert cols.asDict() == {"pixel_0": 0, "pixel_1": 1, "pixel_2": 2}
    oh = spark.createDataFrame([(2,)], "y int").select(S.one_hot("y", 4)).first()[0]
    assert oh == [0.0, 0.0, 1.0, 0.0]
    assert S.reshape_square("a", 10) is not None  # non-square length gives a null literal column


def test_confidence_and_formats(spark):
    df = spark.createDataFrame([(0.1, 1, 0), (0.75, 1, 1)], "p double, y int, yhat int")
    r = df.select(S.confidence_binary("p").alias("c"), S.correct_flag("y", "yhat").alias("ok"),
                  S.fmt_fixed(F.lit(2.0 / 3.0), 4).alias("f4"), S.fmt_percent(F.lit(12.345), 1).alias("pc"),
                  S.fmt_grouped(F.lit(1234567)).alias("g"), S.upper_name(F.lit("rbf")).alias("u")).collect()
    assert math.isclose(r[0]["c"], 0.9) and math.isclose(r[1]["c"], 0.75)
    assert [x["ok"] for x in r] == [0, 1]
    assert r[0]["f4"] == "0.6667" and r[0]["pc"] == "12.3%" and r[0]["g"] == "1,234,567" and r[0]["u"] == "RBF"


def test_softmax_sums_to_one(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0],)], "a array<double>")
    p = df.select(S.softmax("a")).first()[0]
    assert math.isclose(sum(p), 1.0) and p[2] > p[1] > p[0]
