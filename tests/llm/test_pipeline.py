"""The corpus pipeline stage by stage, and the registered queries."""

from __future__ import annotations

import pytest

pytest.importorskip("classbench.llm")

import __spark_entry__ as entry  # noqa: E402
import corpus_pipeline  # noqa: E402
from classbench.llm.common import materialize  # noqa: E402
from test_operators import base_spans, brute_fingerprint, classes  # noqa: E402


def test_stages_keep_what_they_should(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "simhash", "pii", "mixing", "packing"]

    kept = materialize(stages["toxicity"](spark, docs, sf_dir), "t")
    left = {r.doc_id for r in kept.collect()}
    assert kept.columns == columns and all(i in left for i, y in labels.items() if y == 0)

    rows = kept.collect()
    once = materialize(stages["simhash"](spark, kept, sf_dir), "s")
    prints = {r.doc_id: brute_fingerprint(r.text) for r in rows}
    group = classes(set(prints.values()), 2)
    least = {}
    for i, f in prints.items():
        least[group[f]] = min(least.get(group[f], i), i)
    assert once.columns == columns and sorted(r.doc_id for r in once.collect()) == sorted(least.values())

    clean = materialize(stages["pii"](spark, once, sf_dir), "p")
    assert clean.columns == columns and clean.count() == once.count()
    assert all(base_spans(r.text) == "" and r.n_chars == len(r.text) for r in clean.collect())

    mixed = materialize(stages["mixing"](spark, clean, sf_dir), "m")
    assert mixed.columns == columns and mixed.count() > 0
    packed = stages["packing"](spark, mixed, sf_dir)
    assert packed.select("doc_id").distinct().count() == mixed.select("doc_id").distinct().count()


def test_near_duplicates_are_dropped_by_row(spark):
    one, two, three = (" ".join(f"{w}{i}" for i in range(60)) for w in ("alpha", "beta", "gamma"))
    rows = [(1, one, "a"), (7, one, "b"), (7, two, "c"), (None, two, "d"), (None, three, "e"), (None, three, "e"), (9, one, "f"), (1, one, "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for parts in (1, 5):
        got = corpus_pipeline.drop_near_duplicates(spark, docs.repartition(parts), "").collect()
        assert sorted((str(r.doc_id), r.text, r.source) for r in got) == [("1", one, "a"), ("7", two, "c"), ("None", three, "e")]


CLASHING = ("doc_id long, text string, lang string, source string, n_chars int, _hash string, _named int, _id string, _ID_ string, "
            "_row int, _spans string, _words long, _copies int, _copy int, _source string, _size int, score double, fp long")


def test_stages_with_clashing_columns_nulls_ties_and_empty_tables(spark):
    text = " ".join(f"plain{i} word" for i in range(40))
    rest = ("h", 1, "i", "I", 2, "s", 3, 4, 5, "o", 6, 0.5, 7)
    rows = [(1, text, "en", "a", len(text), *rest), (1, text, "en", "a", len(text), *rest), (2, text, "en", "b", len(text), *rest),
            (None, None, None, None, None, *rest), (3, "", "en", None, 0, *rest), (4, "mail a@b.cc now " + "w " * 50_000, "en", "a", 100_016, *rest)]
    docs = spark.createDataFrame(rows, CLASHING)
    stages = dict(corpus_pipeline.STAGES)
    labels = "/root/testdata/sf0.001"
    for name in ("toxicity", "simhash", "pii", "mixing"):
        before = {str(r.doc_id): r.asDict() for r in docs.collect()}
        docs = materialize(stages[name](spark, docs, labels), name)
        assert docs.columns == [f.split()[0] for f in CLASHING.split(", ")]
        left = docs.collect()
        assert {str(r.doc_id) for r in left} >= ({"4"} if name == "mixing" else {"1", "4"})
        for r in left:  # other columns as they were
            assert all(v == before[str(r.doc_id)][k] for k, v in r.asDict().items() if k not in ("text", "n_chars"))
        if name == "simhash":
            assert sorted(str(r.doc_id) for r in left) == ["1", "3", "4"]
        if name == "pii":
            assert all("a@b.cc" not in (r.text or "") for r in left)
    assert stages["packing"](spark, docs, labels).count() > 0
    for name in stages:
        assert stages[name](spark, spark.createDataFrame([], CLASHING), labels).count() == 0


def test_queries_are_registered():
    names = entry.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14))
    assert {"op1_pii", "op9_warc", "op11_variants"} <= entry.oracle_sql().keys()
