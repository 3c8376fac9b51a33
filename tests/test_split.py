import math

import pytest
from pyspark.sql import functions as F

from classbench.operators import split
from classbench.sources import fixtures as FX
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def f1(spark):
    return FX.orders_churn(spark, SF_SMALL).select("id", "Churn").persist()


def _parts(df):
    return {r["id"]: r["split"] for r in df.collect()}


def test_split_disjoint_complete_and_exact_share(f1):
    s = split.stratified_split(f1, "id", "Churn", 0.2, 42)
    rows = s.collect()
    assert len(rows) == f1.count() and len({r["id"] for r in rows}) == len(rows)
    for cls in (True, False):
        n_c = sum(1 for r in rows if r["Churn"] == cls)
        n_t = sum(1 for r in rows if r["Churn"] == cls and r["split"] == "test")
        assert n_t == math.floor(n_c * 0.2 + 0.5)


def test_split_independent_of_layout_and_buckets(f1):
    base = _parts(split.stratified_split(f1, "id", "Churn", 0.2, 42))
    for p in (1, 4, 16):
        assert _parts(split.stratified_split(f1.repartition(p), "id", "Churn", 0.2, 42)) == base
    # one bucket per class, a few buckets, and the default 2**20 buckets give the same ranks
    for bits in (0, 3):
        assert _parts(split.stratified_split(f1, "id", "Churn", 0.2, 42, bits=bits)) == base


def test_seed_changes_split(f1):
    a = _parts(split.stratified_split(f1, "id", "Churn", 0.2, 42))
    b = _parts(split.stratified_split(f1, "id", "Churn", 0.2, 7))
    assert a != b


def test_three_way(f1):
    s = split.three_way_split(f1, "id", "Churn", 0.2, 0.2, 42).collect()
    n = len(s)
    counts = {k: sum(1 for r in s if r["split"] == k) for k in ("train", "validation", "test")}
    assert sum(counts.values()) == n and abs(counts["validation"] - 0.2 * n) <= 2
    assert abs(counts["test"] - 0.2 * n) <= 2


@pytest.mark.parametrize("shuffle", [True, False])
def test_kfold_balanced(f1, shuffle):
    k = split.stratified_kfold(f1, "id", "Churn", 5, 42, shuffle=shuffle, rows_per_bucket=64)
    per = k.groupBy("Churn", "fold").count().collect()
    for cls in (True, False):
        sizes = [r["count"] for r in per if r["Churn"] == cls]
        assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1


def test_unshuffled_folds_are_contiguous(f1):
    k = split.stratified_kfold(f1, "id", "Churn", 5, shuffle=False).collect()
    for cls in (True, False):
        ordered = sorted((r["id"], r["fold"]) for r in k if r["Churn"] == cls)
        folds = [f for _, f in ordered]
        assert folds == sorted(folds)


def test_tail_holdout_and_head(f1):
    t = split.tail_holdout(f1, "id", 0.2, rows_per_bucket=100).collect()
    n = len(t)
    val = sorted(r["id"] for r in t if r["split"] == "validation")
    assert len(val) == n - math.floor(0.8 * n)
    assert min(val) > max(r["id"] for r in t if r["split"] == "train")
    h = [r["id"] for r in split.head(f1, 3).collect()]
    assert h == sorted(r["id"] for r in f1.collect())[:3]


@pytest.mark.parametrize("kind", ["bigint", "string", "date"])
def test_ranks_for_any_number_of_ranges(spark, kind):
    """Ids of any ordered type, some null: the same ranks for one and for many ranges."""
    from classbench.operators.rank import ranged_rank, value_rank
    key = {"bigint": "id * 7919 % 1009", "string": "concat('k', id * 7919 % 1009)", "date": "date_add(date'2020-01-01', int(id * 7919 % 1009))"}[kind]
    df = spark.range(1009).selectExpr("id as row", f"if(id % 50 = 3, null, {key}) as k", "if(id % 3 = 0, null, id % 3) as c").repartition(4)
    read = lambda d: {r.row: (r._rank, r._total) for r in d.where("k is not null").collect()}
    for part in ([], ["c"]):
        base = read(value_rank(df, "k", part))
        for ranges in (1, 7, 200):
            out = ranged_rank(df, ["k"], ranges, part)
            assert read(out) == base
            whole = sorted((str(r.c) if part else "", r._rank) for r in out.collect())
            assert len(set(whole)) == 1009 and all(out.where("k is null").select(F.col("_rank") > 0).toPandas().iloc[:, 0])


def test_ranks_outside_each_fold(f1):
    """One ranking for all folds gives what ranking each training part gives, and its plan shuffles the rows once."""
    folded = f1.withColumn("fold", (F.xxhash64("id") % 3 + 3) % 3)
    one = {r["id"]: r["_ranks"] for r in split.hash_fold_ranks(folded, "id", "fold", 3, 42, "curve|").collect()}
    for f in range(3):
        ranked, _ = split.hash_rank(folded.where(F.col("fold") != f), "id", None, 42, "curve|")
        assert {r["id"]: r["_rank"] for r in ranked.collect()} == {i: r[f] for i, r in one.items() if r[f] is not None}
