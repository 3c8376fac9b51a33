"""Toxicity by a factorization machine over hashed terms.

Terms are lower-cased words and their first four and five letters, hashed.  The
machine scores ``w0 + sum w_i + sum_{i<j} <v_i, v_j>`` over the terms of a text,
so two terms together can weigh more or less than each alone.  It is fitted on
the driver from a bounded sample of labelled rows (``max_fit_rows``), of which
only the terms that differ between the classes (at most ``max_terms``) arrive
there; term counts of the sample and all scoring are Spark jobs.  A sampled row
weighs as many labels as it stands for, so the classes keep their share of all
labels whatever the sample's mix.

Defined results: null and empty texts have no terms and get the machine's
intercept; rows with a null id are scored and count as held out, as does the
checksum of an empty string; null labels are not learnt from; repeated labels
count repeatedly; without labels of both classes every score is the share of
toxic labels (0 without any); an empty table yields no rows.  Other columns are
passed over, so their names cannot clash.
"""

from __future__ import annotations

import re
import sys
import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from classbench.llm.common import materialize, read_table
from classbench.session import ship_by_value

WORD = re.compile(r"[^\W\d_]+")
HASH_BITS = 22
#: Words whose term hashes a task remembers.
CACHE_WORDS = 400_000


def word_terms(word: str) -> tuple[int, ...]:
    """Hashed terms of one lower-cased word: itself and its beginnings of four and five letters."""
    mask = (1 << HASH_BITS) - 1
    return tuple({zlib.crc32(t.encode()) & mask for t in (word, "4" + word[:4], "5" + word[:5])})


def text_words(text: str | None) -> set[str]:
    return set(WORD.findall((text or "").lower()))


@dataclass
class FactorizationMachine:
    """Weights of the selected terms; ``index`` maps a term hash to its row of ``w`` and ``v``."""

    index: dict[int, int]
    w0: float
    w: np.ndarray
    v: np.ndarray

    def score(self, rows: list[list[int]]) -> np.ndarray:
        """Probabilities for lists of weight rows."""
        out = np.full(len(rows), self.w0)
        for i, ids in enumerate(rows):
            if ids:
                v = self.v[ids]
                out[i] += self.w[ids].sum() + 0.5 * ((v.sum(0) ** 2).sum() - (v ** 2).sum())
        return 1.0 / (1.0 + np.exp(-np.clip(out, -35, 35)))

    @classmethod
    def fit(cls, rows: list[list[int]], labels: list[int], index: dict[int, int], factors: int = 4, epochs: int = 30,
            rate: float = 0.1, l2: float = 1e-4, seed: int = 7, weights: list[float] | None = None) -> FactorizationMachine:
        """Adagrad on the logistic loss, 64 rows a step; ``weights`` (all 1 by default) are scaled to a mean of 1."""
        rng, n = np.random.default_rng(seed), len(index)
        y = np.asarray(labels, float)
        weight = np.ones(len(y)) if weights is None else np.asarray(weights, float)
        if len(y):
            weight = weight / weight.mean()
        share = np.average(y, weights=weight) if len(y) else 0.0
        m = cls(index, 0.0, np.zeros(n), rng.normal(0, 0.05, (n, factors)))
        if not 0 < share < 1:
            m.w0 = 35.0 if share else -35.0
            return m
        m.w0 = float(np.log(share / (1 - share)))
        g0, gw, gv = 1e-6, np.full(n, 1e-6), np.full((n, factors), 1e-6)
        for _ in range(epochs):
            order = rng.permutation(len(y))
            for first in range(0, len(y), 64):
                at = order[first:first + 64]
                size = [len(rows[i]) for i in at]
                doc = np.repeat(np.arange(len(at)), size)
                ids = np.array([x for i in at for x in rows[i]], int)
                v, total = m.v[ids], np.zeros((len(at), factors))
                np.add.at(total, doc, v)
                z = m.w0 + np.bincount(doc, m.w[ids], len(at)) + 0.5 * (
                    (total ** 2).sum(1) - np.bincount(doc, (v ** 2).sum(1), len(at)))
                e = weight[at] * (1 / (1 + np.exp(-np.clip(z, -35, 35))) - y[at])
                g0 += e.sum() ** 2
                m.w0 -= rate * e.sum() / np.sqrt(g0)
                used, inv = np.unique(ids, return_inverse=True)
                dw = np.bincount(inv, e[doc], len(used)) + l2 * m.w[used]
                dv = np.zeros((len(used), factors))
                np.add.at(dv, inv, e[doc][:, None] * (total[doc] - v))
                dv += l2 * m.v[used]
                gw[used] += dw ** 2
                gv[used] += dv ** 2
                m.w[used] -= rate * dw / np.sqrt(gw[used])
                m.v[used] -= rate * dv / np.sqrt(gv[used])
        return m


def held_out(doc_id: Column) -> Column:
    """Rows that are never learnt from: CRC-32 of the id's text divisible by five."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5 == 0


def labelled_sample(labels: DataFrame, label: str, max_fit_rows: int) -> DataFrame:
    """At most ``max_fit_rows`` labelled ids, by a hash of the id, half of them of the rarer kind if there are so many.

    ``weight`` is the number of labels of its kind that a sampled row stands for, counted over all labels.
    """
    rows = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).select(
        "doc_id", F.col(label).cast("int").alias("label"))
    half = max_fit_rows // 2
    total = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    pick = lambda y: rows.where(F.col("label") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(half).withColumn(
        "weight", F.lit(max(1.0, total.get(y, 0) / max(half, 1))))
    return pick(0).union(pick(1))


def fit_toxicity(docs: DataFrame, labels: DataFrame, text_col: str = "text", label: str = "toxic",
                 max_fit_rows: int = 20_000, max_terms: int = 3_000, least_z: float = 5.0) -> FactorizationMachine:
    """Fit the machine from ``labels`` (doc_id, label) and the texts of ``docs``."""
    ship_by_value(sys.modules[__name__])

    @F.pandas_udf("array<int>")
    def hashed(text: pd.Series) -> pd.Series:
        return pd.Series([sorted({h for w in text_words(t) for h in word_terms(w)}) for t in text])

    chosen = F.broadcast(labelled_sample(labels, label, max_fit_rows))  # max_fit_rows rows of three numbers
    sample = materialize(docs.select("doc_id", text_col).join(chosen, "doc_id").select(
        "doc_id", "label", "weight", hashed(F.col(text_col)).alias("terms")), "toxicity")
    sizes = sample.agg(F.count("*").alias("n"), F.sum("label").alias("n1")).first()
    n, n1 = sizes["n"], sizes["n1"] or 0
    n0 = n - n1
    if not n0 or not n1:
        return FactorizationMachine.fit([], [1] * n1 + [0] * n0, {})
    term = sample.select("label", F.explode("terms").alias("term")).groupBy("term").agg(
        F.count("*").alias("c"), F.sum("label").alias("c1")).where("c >= 3")
    p = F.col("c") / n
    z = F.abs(F.col("c1") / n1 - (F.col("c") - F.col("c1")) / n0) / F.sqrt(p * (1 - p) * (1 / n1 + 1 / n0) + 1e-12)
    best = term.select("term", z.alias("z")).where(F.col("z") >= least_z).orderBy(F.desc("z"), "term").limit(max_terms)
    index = {r["term"]: i for i, r in enumerate(best.collect())}
    known = sample.select("doc_id", "label", "weight", F.explode_outer("terms").alias("term")).join(
        F.broadcast(best.select("term", F.lit(1).alias("known"))), "term", "left")
    rows = known.groupBy("doc_id", "label", "weight").agg(F.collect_list(F.when(F.col("known") == 1, F.col("term"))).alias("terms"))
    got = sorted(rows.collect(), key=lambda r: (zlib.crc32(str(r["doc_id"]).encode()), r["doc_id"], r["label"]))
    return FactorizationMachine.fit([sorted(index[t] for t in r["terms"]) for r in got], [r["label"] for r in got], index,
                                    weights=[r["weight"] for r in got])


def toxicity_score(machine: FactorizationMachine, text: Column) -> Column:
    """Column of probabilities; the machine in the closure is bounded by ``max_terms``."""
    ship_by_value(sys.modules[__name__])

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        known: dict[str, tuple[int, ...]] = {}
        index, rows = machine.index, []
        for text in texts:
            found: set[int] = set()
            for w in text_words(text):
                ids = known.get(w)
                if ids is None:
                    if len(known) >= CACHE_WORDS:
                        known.clear()
                    known[w] = ids = tuple(index[h] for h in word_terms(w) if h in index)
                if ids:
                    found.update(ids)
            rows.append(sorted(found))
        return pd.Series(machine.score(rows))

    return score(text)


def score_toxicity(docs: DataFrame, labels: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with ``score`` and ``predicted`` (columns of these names are replaced)."""
    machine = fit_toxicity(docs, labels, text_col)
    scored = docs.withColumn("score", toxicity_score(machine, F.col(text_col)))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op10_toxicity(spark, sf_dir) -> DataFrame:
    """Score of every document, learnt from the labels that are not held out."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score_toxicity(docs, read_table(spark, sf_dir, "labels"))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
