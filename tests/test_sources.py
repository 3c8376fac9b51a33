import pytest

from classbench import spec
from classbench.session import new_scratch_path
from classbench.sources import io


def test_csv_infers_booleans_and_nulls(spark):
    path = new_scratch_path(spark, "csv-test")
    spark.createDataFrame([(1, "x", True), (2, None, False)], "a int, s string, Churn boolean") \
        .write.option("header", True).csv(path)
    df = io.read_csv(spark, path)
    assert dict(df.dtypes)["Churn"] == "boolean"
    assert sorted(r["s"] for r in df.collect() if r["s"]) == ["x"]


def test_read_first_records_source(spark):
    good = new_scratch_path(spark, "good")
    spark.range(3).write.parquet(good)
    df, used = io.read_first(spark, [("missing", lambda: spark.read.parquet("/nonexistent/x")),
                                     ("good", lambda: spark.read.parquet(good))])
    assert used == "good" and df.count() == 3
    with pytest.raises(FileNotFoundError):
        io.read_first(spark, [("missing", lambda: spark.read.parquet("/nonexistent/y"))])


def test_report_sink_round_trip(spark):
    one = spark.createDataFrame([("forest", 100, 0.91)], "model string, trees int, acc double")
    got = io.report_sink(one, new_scratch_path(spark, "report"))
    assert {r["field"]: r["Value"] for r in got.collect()} == {"model": "forest", "trees": "100", "acc": "0.91"}


def test_target_resolution_and_spec(spark):
    assert spec.resolve_target(["a", "Class", "target"]) == "target"
    assert spec.resolve_target(["a", "b"]) == "b"
    assert spec.app_target(["x", "Churn"]) == "Churn"
    df = spark.createDataFrame([(1, "s", 2.0, True)], "id long, State string, mins double, Churn boolean")
    ts = spec.table_spec(df)
    assert ts.target == "Churn" and ts.categorical == ("State",) and ts.numeric == ("mins",)


def test_artifact_table(spark):
    t = io.artifacts(spark, {"model": "/x/model", "report": "/x/report.csv"})
    assert [tuple(r) for r in t.collect()] == [("model", "/x/model"), ("report", "/x/report.csv")]


def test_prepare_csv_end_to_end(spark):
    """A churn-style CSV (no id, text categoricals with a null, text target) runs through a forest."""
    from pyspark.sql import functions as F
    from classbench.models.forest import forest, score
    from classbench.operators import curves
    from classbench.plans.prepare import prepare_table
    rows = []
    for i in range(400):
        state = ["KS", "OH", "NJ", None][i % 4]
        plan = "yes" if i % 3 == 0 else "no"
        minutes = float((i * 37) % 300)
        churn = "True" if (plan == "yes" and minutes > 150) else "False"
        rows.append((state, plan, minutes, churn))
    path = new_scratch_path(spark, "churn-csv")
    spark.createDataFrame(rows, "State string, `International plan` string, `Total day minutes` double, "
                                "Churn string").coalesce(1).write.option("header", True).csv(path)
    df = io.read_csv(spark, path)
    p = prepare_table(df, scale=True)
    assert p.spec.target == "Churn" and set(p.spec.categorical) == {"State", "International plan"}
    assert p.train.count() + p.test.count() == 400
    m = forest(20, 6).fit(p.train)
    assert curves.roc_auc(score(m, p.test)).first()[0] > 0.9


def test_row_key_comes_from_what_rows_hold(spark, monkeypatch):
    """The same keys however the rows are cut; copies differ in their ordinal alone, also when made in blocks."""
    from classbench.plans import prepare
    rows = [(1, "a"), (None, "a"), (1, None), (1, "")] * 3 + [(5, "hot")] * 50
    want = None
    for parts, per_task in ((1, 1 << 16), (8, 7)):
        monkeypatch.setattr(prepare, "COPIES_PER_TASK", per_task)
        got = sorted(map(str, prepare.with_row_id(spark.createDataFrame(rows, "x int, y string").repartition(parts)).collect()))
        assert len(set(got)) == len(rows) and (want is None or got == want)
        want = got
    keyed = spark.createDataFrame(rows, "x int, id string")
    assert prepare.with_row_id(keyed) is keyed
    assert prepare.with_row_id(spark.createDataFrame([], "x int, y string")).count() == 0
