"""Spelling variants, positive-unlabelled quality and periodic runs against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

pytest.importorskip("classbench.llm")

from classbench.llm import quality_pu, runs, variants  # noqa: E402

DOC = "doc_id long, text string, word string, n long, runs int, id string, x double"


def docs_of(spark, rows):
    """Documents whose other columns bear the names that the operators use."""
    return spark.createDataFrame([(i, t, "w", 1, 2, "id", 0.5) for i, t in rows], DOC)


# --- spelling variants ---------------------------------------------------

def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) > len(b):
        a, b = b, a
    i = next((k for k in range(len(a)) if a[k] != b[k]), len(a))
    return a[i + 1:] == b[i + 1:] if len(a) == len(b) else a[i:] == b[i + 1:]


def brute_variants(count, times=5):
    out = {}
    for w, n in count.items():
        near = [v for v in count if one_edit(w, v)]
        best = min(near, key=lambda v: (-count[v], v), default=None)
        out[w] = (best if best is not None and count[best] >= times * n else None, n, len(near))
    for w, (form, n, near) in out.items():
        root = w
        while out[root][0] is not None:
            root = out[root][0]
        yield w, form, root, n, near, None if form is None else count[form]


def edited(rng, word, letters):
    i = rng.randrange(len(word) + 1)
    kind = rng.randrange(3)
    if kind == 0:
        return word[:i] + rng.choice(letters) + word[i:]
    i = min(i, len(word) - 1)
    return word[:i] + (rng.choice(letters) if kind == 1 else "") + word[i + 1:]


@pytest.mark.parametrize("letters,seed", [("ab", 1), ("abcé", 2), ("abcdefghijklmnopqrstuvwxyzß", 3), ("aß漢🙂", 4)])
def test_variants_match_brute_force(spark, letters, seed):
    rng = random.Random(seed)
    count = {}
    for _ in range(60):
        word = "".join(rng.choices(letters, k=rng.randint(6, 9)))
        count[word] = rng.randint(1, 4000)
        for _ in range(4):
            word = edited(rng, word, letters)
            if len(word) >= 6:
                count.setdefault(word, rng.choice([1, 1, 2, 7, 40, 900]))
    words = spark.createDataFrame([(w, n, "x") for w, n in count.items()], "word string, n long, key string")
    for parts in (1, 7):
        got = {tuple(r) for r in variants.group_variants(words.repartition(parts)).select(
            "word", "form", "root", "n", "n_near", "form_n").collect()}
        assert got == set(brute_variants(count))


def test_near_words_in_crowded_buckets(spark):
    """A thousand words that share their head or their tail lose no link."""
    rng = random.Random(5)
    words = {"common" + "".join(rng.choices("abc", k=5)) for _ in range(200)} | {"".join(rng.choices("abc", k=5)) + "ending" for _ in range(200)}
    table = spark.createDataFrame([(w, 1) for w in words], "word string, n long")
    got = {(r["word"], r.near) for r in variants.near_words(table).collect()}
    assert got == {(a, b) for a in words for b in words if one_edit(a, b)}


def test_pivots_are_the_cheapest_disjoint_pair():
    rng = random.Random(6)
    for _ in range(300):
        places = sorted(rng.sample(range(12), rng.randint(2, 7)))
        cost = [rng.randint(1, 9) for _ in places]
        pairs = [cost[i] + cost[j] for i in range(len(places)) for j in range(i) if places[i] - places[j] >= 2]
        got = variants.pivots(places, cost)
        assert (got == []) == (not pairs)
        if pairs:
            assert got[1] - got[0] >= 2 and sum(cost[places.index(p)] for p in got) == min(pairs)


def test_chains_ties_and_odd_tables(spark):
    words = spark.createDataFrame([("aaaaaa", 1), ("aaaaab", 5), ("aaaabb", 25), ("aaabbb", 125), ("aabbbb", 625), ("abbbbb", 3125),
                                   ("cccccc", 1), ("cccccd", 9), ("cccccb", 9)], "word string, n long")
    got = {r["word"]: (r.form, r.root, r.form_n) for r in variants.group_variants(words).collect()}
    assert got["aaaaaa"] == ("aaaaab", "abbbbb", 5) and got["abbbbb"] == (None, "abbbbb", None)
    assert got["cccccc"] == ("cccccb", "cccccb", 9)
    assert variants.group_variants(words.limit(0)).count() == 0
    with pytest.raises(ValueError):
        variants.group_variants(words, times=1)


def test_letter_runs(spark):
    docs = docs_of(spark, [(1, "Ab-École×x 9z"), (None, "ÉÀaB"), (2, None), (3, ""), (1, "Ab")])
    got = sorted((r.id, r.run) for r in variants.letter_runs(docs).collect())
    assert got == [("", "ÉÀab"), ("1", "ab"), ("1", "ab"), ("1", "z"), ("1", "École×x")]
    assert [r.run for r in variants.letter_runs(docs, 5).collect()] == ["École×x"]
    long = docs_of(spark, [(1, "abcdefg " * 200_000 + "x" * 300_000)])
    counted = variants.count_words(variants.letter_runs(long, 6).withColumnRenamed("run", "word"), 5).collect()
    assert [(r["word"], r.n) for r in counted] == [("abcdefg", 200_000)]


def test_op11_matches_brute_force(spark, tmp_path):
    rng = random.Random(8)
    pool = ["letter", "lettér", "Spelling", "variant", "variants", "Großes", "grosses", "a", "the"]
    rows = [(i if i % 40 else None, " ".join(rng.choices(pool, weights=[40, 1, 30, 30, 2, 9, 2, 5, 5], k=60))) for i in range(400)] + [(7, None), (8, "")]
    docs_of(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    count = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            low = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{low}".encode())
            if h % 199 == 0:
                low = low[:h % len(low)] + low[h % len(low) + 1:]
            if len(low) >= 6:
                count[low] += 1
    kept = {w: n for w, n in count.items() if n >= 5}
    got = {(r["word"], r.form, r.root, r.n, r.n_near, r.form_n) for r in variants.op11_variants(spark, str(tmp_path)).collect()}
    assert got == set(brute_variants(kept)) and any(f for _, f, *_ in got)


# --- positive-unlabelled quality -----------------------------------------

def test_held_out_quality(spark):
    """Ten thousand documents, some 2,300 trusted positives (with a tenth of that the prior varies by several points)."""
    sf_dir = "/root/testdata/sf0.1"
    got = {r.doc_id: r for r in quality_pu.op12_quality(spark, sf_dir).collect()}
    assert len(got) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for i, r in got.items())
    labels = [(r.quality, got[r.doc_id]) for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect() if got[r.doc_id].held_out]
    good, bad = [r for y, r in labels if y == 1], [r for y, r in labels if y == 0]
    assert len(bad) > 100 and sum(r.predicted for r in good) >= 0.99 * len(good) and sum(r.predicted for r in bad) <= 0.05 * len(bad)
    assert sum(g.score > b.score for g in good for b in bad) >= 0.99 * len(good) * len(bad)


def test_moments_risk_and_prior(spark):
    rng = np.random.default_rng(1)
    bad = rng.random(3000) < 0.3
    x = rng.normal(0, 1, (3000, len(quality_pu.STATISTICS))) + 3 * bad[:, None] * (np.arange(len(quality_pu.STATISTICS)) < 3)
    good = ~bad & (rng.random(3000) < 0.2)
    stats = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)], "id long, x array<double>, good int")
    positives = spark.createDataFrame([(int(i),) for i in np.flatnonzero(good)] * 2 + [(None,)], "id long")
    scorers = [quality_pu.fit_quality(stats.repartition(parts), positives) for parts in (1, 6)]
    scorer, prior = scorers[0]
    assert np.allclose(scorer.weights, scorers[1][0].weights, atol=1e-9) and abs(prior - 0.7) < 0.06
    assert ((scorer.score(x) >= 0.5) == ~bad).mean() > 0.9  # some 420 positives for about 150 features
    # moments and both terms of the risk, row by row
    rows = stats.select("x", F.col("id").isin([int(i) for i in np.flatnonzero(good)]).alias("good"), (F.col("id") % 2).cast("int").alias("half"))
    halves = quality_pu.moments(rows, scorer)
    phi, g = scorer.features(x), scorer.features(x) @ scorer.weights
    for h in (0, 1):
        at = np.arange(3000) % 2 == h
        assert np.allclose(halves[h].second[1], phi[at].T @ phi[at]) and np.allclose(halves[h].first[0], phi[at & good].sum(0))
    one, two = quality_pu.non_negative_risk(halves[0] + halves[1], prior, scorer.weights)
    assert np.isclose(one, prior * ((1 - g[good]) ** 2 / 4).mean())
    assert np.isclose(two, ((1 + g) ** 2 / 4).mean() - prior * ((1 + g[good]) ** 2 / 4).mean())

    def risk(w):
        a, b = quality_pu.non_negative_risk(halves[0] + halves[1], prior, w)
        return a + max(b, 0) + 0.5 * w @ quality_pu._ridge(len(w), 1e-3) @ w
    least = risk(scorer.weights)
    assert all(risk(scorer.weights + rng.normal(0, s, len(g[:1]) * len(scorer.weights))) >= least - 1e-6 for s in (1e-3, 1e-2, 0.1) for _ in range(30))


def test_quality_of_odd_tables(spark):
    docs = docs_of(spark, [(1, "a few plain words here. " * 30), (2, None), (3, ""), (None, "###"), (1, "a few plain words here. " * 30), (4, "w " * 400_000)])
    stats = quality_pu.with_statistics(docs)
    assert sorted(stats.columns) == ["id", "x"] and stats.count() == 6
    none = spark.createDataFrame([], "id long")
    scorer, prior = quality_pu.fit_quality(stats, none)
    assert prior == 0.5 and {r[0] for r in stats.select(quality_pu.quality_score(scorer, F.col("x"))).collect()} == {0.5}
    scorer, _ = quality_pu.fit_quality(stats, spark.createDataFrame([(1,), (1,), (None,)], "id long"))
    assert all(0 <= r[0] <= 1 for r in stats.select(quality_pu.quality_score(scorer, F.col("x"))).collect())
    empty = quality_pu.with_statistics(docs.limit(0))
    scorer, _ = quality_pu.fit_quality(empty, none)
    assert empty.select(quality_pu.quality_score(scorer, F.col("x"))).count() == 0
    assert quality_pu.statistics(None) == quality_pu.statistics(" \n") == (0.0,) * len(quality_pu.STATISTICS)


# --- periodic runs -------------------------------------------------------

def brute_runs(w, shortest=24, times=3):
    out = {}
    for q in range(1, len(w) // times + 1):
        i = 0
        while i < len(w) - q:
            j = i
            while j < len(w) - q and w[j] == w[j + q]:
                j += 1
            if j > i and j + q - i >= max(shortest, times * q):
                out.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted((s, e, q) for (s, e), q in out.items())


def sequences(rng):
    letters = rng.choice([1, 2, 3, 5, 30])
    draw = lambda k: [rng.randrange(letters) for _ in range(k)]
    yield draw(rng.randint(0, 200))
    yield sum((draw(rng.randint(1, 12)) * rng.randint(1, 8) for _ in range(6)), [])
    a, b = [0], [1]
    for _ in range(rng.randint(5, 10)):
        a, b = a + b, a
    yield a[rng.randrange(5):]
    yield (draw(rng.randint(1, 9)) * rng.randint(3, 6) + draw(rng.randint(0, 9))) * rng.randint(1, 5)
    w = [rng.randrange(40) for _ in range(200)]
    for _ in range(3):
        a, p = rng.randrange(170), rng.randint(1, 15)
        for i in range(a, min(200, a + rng.randint(20, 80))):
            w[i] = w[a + (i - a) % p]
    yield w
    yield ([0] * rng.randint(0, 80) + [1] + [0] * rng.randint(0, 80) + draw(10)) * rng.randint(1, 3)


def test_runs_match_brute_force():
    rng, total = random.Random(11), 0
    for _ in range(250):
        for w in sequences(rng):
            want = brute_runs(w)
            total += len(want)
            assert runs.find_runs(w) == want, w
            assert runs.find_runs(w, 30, 4) == brute_runs(w, 30, 4), w
    assert total > 1000
    with pytest.raises(ValueError):
        runs.find_runs([1] * 50, 10, 2)


def test_re_pair_grammar():
    rng = random.Random(12)
    for _ in range(60):
        for w in sequences(rng):
            ids = [w.index(v) for v in w]
            start, places, rules = runs.re_pair(ids, 1000)
            spell = lambda s: [s] if s < 1000 else spell(rules[s - 1000][0]) + spell(rules[s - 1000][1])  # noqa: E731, B023
            assert sum(map(spell, start), []) == ids
            assert places == [sum(len(spell(s)) for s in start[:k]) for k in range(len(start))]
            pairs, last = Counter(), None  # no pair is left twice, overlaps aside
            for k, pair in enumerate(zip(start, start[1:])):
                if last != (k - 1, pair):
                    pairs[pair] += 1
                    last = (k, pair)
            assert not pairs or max(pairs.values()) == 1


def test_long_repetitive_texts():
    assert runs.find_runs([7] * 300_000) == [(0, 300_000, 1)]
    passage = random.Random(1).choices(range(10 ** 6), k=40_000)
    assert runs.find_runs(passage * 3) == [(0, 120_000, 40_000)]
    assert runs.find_runs([*range(400)] * 250) == [(0, 100_000, 400)]
    assert runs.find_runs([w for k in range(2000) for w in (-k - 1, *range(30))]) == []


def test_op13_matches_brute_force(spark, tmp_path):
    rng = random.Random(13)
    texts = [None, "", " \t\x0b", "one", "la " * 40, "x\ny " * 30 + "é\x85é " * 25]
    texts += [" ".join(f"w{v}" for v in w) for _ in range(12) for w in sequences(rng)]
    rows = [(i, t) for i, t in enumerate(texts * 3)] + [(None, "la " * 40), (3, "one"), (3, "one")]
    docs_of(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    want = []
    for i, text in rows:
        w = re.findall("[^\x20\x09-\x0D]+", text or "")
        h, n = zlib.crc32(("" if i is None else str(i)).encode()), len(w)
        if h % 10 == 0 and n:
            g = h // 10
            a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
            w = [w[k] if k < a else w[a + (k - a) % p] for k in range(n)]
        found = brute_runs(w)
        top = min(found, key=lambda r: (-Fraction(r[1] - r[0], r[2]), r[0], r[2]), default=None)
        dropped = {k for s, e, q in found for k in range(s + q, e)}
        lines = "".join(f"{s},{e - s},{q}\n" for s, e, q in found)
        kept = " ".join(v for k, v in enumerate(w) if k not in dropped)
        best = (top[0], top[1] - top[0], top[2], 1000 * (top[1] - top[0]) // top[2]) if top else (None,) * 4
        want.append((i, len(found), *best, *(hashlib.sha256(x.encode()).hexdigest() for x in (lines, kept))))
    got = runs.op13_runs(spark, str(tmp_path))
    assert [t for _, t in got.dtypes] == ["bigint"] * 6 + ["string"] * 2
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)
    assert runs.text_runs(docs_of(spark, rows).limit(0)).count() == 0
