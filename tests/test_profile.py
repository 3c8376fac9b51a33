import math

import numpy as np
import pytest

from classbench.operators import profile
from classbench.operators.quantile import exact_quantiles, select_ranks


@pytest.fixture()
def small(spark):
    rows = [(1, "a", 1.0, True), (2, "b", 2.0, False), (3, "a", None, True), (4, None, 6.0, None),
            (5, "c", 3.0, False)]
    return spark.createDataFrame(rows, "id long, cat string, x double, y boolean")


def test_shape_schema_missing(small):
    assert small.transform(profile.shape).first().asDict() == {"n_rows": 5, "n_columns": 4}
    sp = {r["name"]: (r["dtype"], r["non_null"]) for r in profile.schema_profile(small).collect()}
    assert sp == {"id": ("bigint", 5), "cat": ("string", 4), "x": ("double", 4), "y": ("boolean", 4)}
    assert profile.missing_total(small).first()[0] == 3
    per = {r["name"]: r["missing"] for r in profile.missing_by_column(small).collect()}
    assert per == {"id": 0, "cat": 1, "x": 1, "y": 1}


def test_value_counts_drop_null_and_order(small):
    vc = [(r["value"], r["count"]) for r in profile.value_counts(small, "cat").collect()]
    assert vc == [("a", 2), ("b", 1), ("c", 1)]
    share = {r["value"]: r["percent"] for r in profile.class_share(small, "cat").collect()}
    assert share == {"a": 50.0, "b": 25.0, "c": 25.0}


def test_positive_rate_all_rows_denominator(small):
    assert profile.positive_rate(small, "y").first()[0] == pytest.approx(40.0)
    assert profile.positive_rate(small, None).first()[0] == 0.0


def test_describe_matches_pandas(spark):
    rng = np.random.default_rng(0)
    vals = rng.normal(size=257).round(3)
    df = spark.createDataFrame([(float(v),) for v in vals], "v double")
    r = profile.describe(df).first()
    assert r["count"] == 257
    assert r["std"] == pytest.approx(np.std(vals, ddof=1))
    for q, k in ((0.25, "q25"), (0.5, "q50"), (0.75, "q75")):
        assert r[k] == pytest.approx(np.quantile(vals, q))


@pytest.mark.parametrize("direct", [4, 64, 1 << 18])
def test_exact_quantile_narrowing_with_hot_value(spark, direct):
    rng = np.random.default_rng(1)
    vals = np.concatenate([np.full(300, 7.0), rng.integers(0, 50, 600).astype(float)])
    df = spark.createDataFrame([(float(v),) for v in vals], "v double").repartition(4)
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
    got = exact_quantiles(df, "v", probs, direct_rows=direct, bins=8)
    assert got == pytest.approx(list(np.quantile(vals, probs)))
    ranks = select_ranks(df, "v", [1, 450, 900], 900, direct_rows=direct, bins=8)
    s = np.sort(vals)
    assert ranks == {1: s[0], 450: s[449], 900: s[899]}


def test_histogram_last_bin_closed_and_empty_bins(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (1.0,), (10.0,)], "x double")
    h = profile.histogram(df, "x", 5).orderBy("bin").collect()
    assert [r["count"] for r in h] == [3, 0, 0, 0, 1]
    assert h[0]["lo"] == 0.0 and h[-1]["hi"] == 10.0
    const = spark.createDataFrame([(3.0,), (3.0,)], "x double")
    hc = profile.histogram(const, "x", 2).orderBy("bin").collect()
    assert sum(r["count"] for r in hc) == 2 and hc[0]["lo"] == 2.5


def test_grouped_histogram_shares_edges(spark):
    df = spark.createDataFrame([(0.0, 0), (4.0, 1), (2.0, 1)], "x double, g int")
    h = profile.histogram(df, "x", 2, group="g").collect()
    assert len(h) == 4 and {(r["g"], r["bin"]): r["count"] for r in h} == {(0, 1): 1, (0, 2): 0, (1, 1): 0, (1, 2): 2}


def test_box_summary(spark):
    vals = [1.0, 2.0, 3.0, 4.0, 100.0]
    df = spark.createDataFrame([("m", v) for v in vals], "g string, v double")
    r = profile.box_summary(df, "v", ["g"]).first()
    assert (r["q1"], r["median"], r["q3"]) == (2.0, 3.0, 4.0)
    assert r["whisker_lo"] == 1.0 and r["whisker_hi"] == 4.0 and r["n_outliers"] == 1
    assert [x["v"] for x in profile.box_outliers(df, "v", ["g"]).collect()] == [100.0]


def test_width_gate(spark):
    wide = spark.createDataFrame([tuple(range(60))], ",".join(f"c{i} int" for i in range(60)))
    g = profile.width_gate(wide, "c59")
    assert not g["show_stats"] and g["sample_columns"] == ["c59"] + [f"c{i}" for i in range(10)]
    narrow = spark.createDataFrame([(1, 2)], "a int, b int")
    assert profile.width_gate(narrow, "b")["show_stats"]


def test_many_column_quantiles_match_numpy(spark):
    from classbench.operators.quantile import exact_quantiles_many
    rng = np.random.default_rng(3)
    a = rng.normal(size=2000)
    b = np.concatenate([np.full(700, 5.0), rng.integers(0, 9, 1300).astype(float)])
    c = rng.exponential(size=2000)
    df = spark.createDataFrame([(float(x), float(y), float(z)) for x, y, z in zip(a, b, c)],
                               "a double, b double, c double").repartition(3)
    probs = [0.0, 0.25, 0.5, 0.75, 1.0]
    for acc, direct in ((10_000, 1 << 18), (50, 16)):
        got = exact_quantiles_many(df, ["a", "b", "c"], probs, accuracy=acc, direct_rows=direct)
        for name, arr in (("a", a), ("b", b), ("c", c)):
            assert got[name] == pytest.approx(list(np.quantile(arr, probs)))


def test_box_summary_groups(spark):
    rng = np.random.default_rng(5)
    vals = rng.normal(size=300)
    df = spark.createDataFrame([("a" if i % 3 else "b", float(v)) for i, v in enumerate(vals)],
                               "g string, v double")
    got = {r["g"]: r for r in profile.box_summary(df, "v", ["g"]).collect()}
    for g, arr in (("a", vals[[i for i in range(300) if i % 3]]), ("b", vals[::3])):
        assert got[g]["n"] == len(arr)
        assert got[g]["q1"] == pytest.approx(np.quantile(arr, 0.25))
        assert got[g]["median"] == pytest.approx(np.quantile(arr, 0.5))


def test_grouped_quantiles_by_any_number_of_ranges(spark):
    from classbench.operators.quantile import grouped_quantiles
    rng = np.random.default_rng(8)
    groups = {"a": rng.normal(size=400), None: np.concatenate([np.full(300, 2.0), rng.integers(0, 5, 100)]), "c": np.array([7.0])}
    rows = [(g, float(v)) for g, arr in groups.items() for v in arr] + [("a", None), ("a", float("nan")), ("e", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    probs = [0.0, 0.1, 0.25, 0.5, 0.99, 1.0]
    for per_range in (1 << 20, 50, 3):
        got = {r.g: r for r in grouped_quantiles(df, "v", ["g"], probs, per_range).collect()}
        assert got["e"].n == 0 and got["e"].q is None and len(got) == 4
        for g, arr in groups.items():
            assert got[g].n == len(arr) and got[g].q == pytest.approx(list(np.quantile(arr, probs)))
    assert grouped_quantiles(df.limit(0), "v", ["g"], probs).count() == 0
