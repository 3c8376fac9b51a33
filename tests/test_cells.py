"""Forests grown on counted cells, vector sums in slices, the narrow landmark table."""

import numpy as np
from pyspark.sql import functions as F

from classbench.models import forest_cells as FC
from classbench.models.forest import forest
from classbench.operators import encode


def rows(spark, n=1500):
    d = spark.range(n).select("id", (F.pmod(F.xxhash64("id"), F.lit(5))).cast("double").alias("a"), (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(997))).cast("double").alias("b"))
    d = d.withColumn("label", ((F.col("a") * 200 + F.col("b")) > 900).cast("double"))
    return encode.assemble(d, ["a", "b"]).select("id", "features", "label").persist()


def test_forest_is_the_same_for_any_limit_and_partitioning(spark):
    d = rows(spark)
    est = forest(4, 8)
    assert isinstance(est, FC.CellForestClassifier)
    one, cut = est._fit(d), est._fit(d.repartition(3), 60)
    said = [[r[0] for r in m.transform(d).orderBy("id").select(F.col("probability").cast("string")).collect()] for m in (one, cut)]
    assert said[0] == said[1] and one.totalNumNodes == cut.totalNumNodes
    assert one.transform(d).where("prediction = label").count() > 1400


def test_a_cell_draws_as_its_rows_do():
    n = np.repeat([1, 7, 40, 500], 20000)
    keys = FC._mix(np.arange(len(n), dtype=np.uint64))
    w = FC.draws(keys, n, FC.tree_key(42, 3)).reshape(4, -1)
    assert np.allclose(w.mean(1), [1, 7, 40, 500], rtol=0.03) and np.allclose(w.var(1), [1, 7, 40, 500], rtol=0.06)


def test_vector_sums_reach_the_driver_once(spark):
    from classbench.models.sums import sum_slices

    v = spark.sparkContext.parallelize([np.arange(10.0)] * 40, 20)
    assert np.array_equal(sum_slices(v), np.arange(10.0) * 40)
    assert sum_slices(spark.sparkContext.parallelize([], 3)) is None


def test_landmark_table_holds_no_products(spark):
    from classbench.models.kernel_svc import LandmarkTable

    table = LandmarkTable(rows(spark, 300), 2, 16)
    assert table.rows.columns == ["id", "label", "fold", "x"]
    table.close()
