"""Quality classifier by positive-unlabelled learning with a non-negative risk.

Texts labelled good are trusted positives; every text of the corpus, its label
unread, is the unlabelled mixture of good and bad.  A model ``g``, linear in
features of the text's statistics, minimises the non-negative risk

    prior * E_good[loss(g)] + max(0, E_all[loss(-g)] - prior * E_good[loss(-g)])

whose second term estimates the risk on the bad texts that nobody labelled; it
cannot fall below zero, so the model is not rewarded for pushing all positives
apart from the rest.  The loss is the square ``(1 - g)^2 / 4``: with an unbounded
loss that is linear far out (the logistic one was tried) a small error of the
prior times a large ``g`` makes the second term negative long before bad texts
are apart, and the model stops there.  With the square, all expectations are
functions of the features' first and second moments, so the risk over every row
of the corpus is minimised exactly from one pass.

The class prior is estimated first: a model of good against all texts is fitted
on each half of the rows (by a hash) and scores the other half, and the prior is
the share of all texts over the share of good texts above the score where an
upper bound of that ratio is least (where good texts alone are left).

The statistics of every row are one narrow table, moments and score counts are
added up over its partitions, and the driver gets sums whose size depends on the
number of features only.  The score is ``(1 + g) / 2`` within 0 and 1.

Defined results: a null or empty text has all statistics zero and is scored like
any other; rows with a null id are scored, are unlabelled and held out if the
checksum of an empty string says so; repeated rows and ids count repeatedly;
labels that are null or other than 1 are not positives, repeated ones count once
a row; without positives every score is 0.5; an empty table yields no rows.
Other columns are not read, so their names cannot clash.
"""

from __future__ import annotations

import sys
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from classbench.llm.common import materialize, read_table
from classbench.models.sums import matrix, sum_vectors
from classbench.session import ship_by_value

STATISTICS = ("log_words", "word_length", "symbols", "upper", "digits", "marks", "distinct", "repeated_lines", "repeated_triples",
              "wordless", "log_line", "commonest", "full_stops", "short_words")
#: Where the corpus's values of a statistic are cut; a feature is one for values above a cut, else zero.
CUT_SHARES = (0.01, 0.03, 0.06, 0.1, 0.25, 0.5, 0.75, 0.9, 0.94, 0.97, 0.99)
#: Bins of a score from 0 to 1 for the prior.
SCORE_BINS = 1000
_SYMBOLS = bytes(set(range(33, 127)) - set(b".,;:'\"!?()-") - set(range(48, 58)) - set(range(65, 91)) - set(range(97, 123)))
_UPPER, _LETTERS, _DIGITS = bytes(range(65, 91)), bytes([*range(65, 91), *range(97, 123)]), bytes(range(48, 58))


def statistics(text: str | None) -> tuple[float, ...]:
    """The statistics of one whole text, in the order of :data:`STATISTICS`."""
    raw = (text or "").encode()
    words = raw.split()
    n = len(words)
    if not n:
        return (0.0,) * len(STATISTICS)
    size = sum(map(len, words))
    among = lambda kind: size_all - len(raw.translate(None, kind))
    size_all = len(raw)
    letters = max(among(_LETTERS), 1)
    count = Counter(words)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    triples = n - 2
    return (float(np.log1p(n)), size / n, among(_SYMBOLS) / n, among(_UPPER) / letters, among(_DIGITS) / size, (raw.count(b"!") + raw.count(b"?")) / n,
            len(count) / n, 1 - len(set(lines)) / len(lines), 1 - len(set(zip(words, words[1:], words[2:]))) / triples if triples > 0 else 0.0,
            sum(k for w, k in count.items() if not any(c > 127 or 65 <= c <= 90 or 97 <= c <= 122 for c in w)) / n,
            float(np.log1p(n / len(lines))), max(count.values()) / n, raw.count(b".") / n, sum(k for w, k in count.items() if len(w) <= 3) / n)


def with_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, x): an array of the statistics of every row, written to the shared folder."""
    ship_by_value(sys.modules[__name__])

    @F.pandas_udf("array<double>")
    def measure(text: pd.Series) -> pd.Series:
        return pd.Series([statistics(t) for t in text])

    return materialize(docs.select(F.col(id_col).alias("id"), measure(F.col(text_col)).alias("x")), "statistics")


@dataclass
class Scorer:
    """Cuts of every statistic and one weight for each cut, after the intercept."""

    cuts: list[list[float]]
    weights: np.ndarray

    @classmethod
    def blank(cls, cuts: list[list[float]]) -> Scorer:
        return cls(cuts, np.zeros(1 + sum(map(len, cuts))))

    def features(self, x: np.ndarray) -> np.ndarray:
        """One, then one for each cut that the value lies above."""
        above = [x[:, [i]] > np.array(c)[None, :] for i, c in enumerate(self.cuts) if c]
        return np.hstack([np.ones((len(x), 1)), *above])

    def score(self, x: np.ndarray) -> np.ndarray:
        """Estimated probabilities that texts are good."""
        return np.clip((1 + self.features(x) @ self.weights) / 2, 0.0, 1.0) if len(x) else np.zeros(0)


def statistic_cuts(rows: DataFrame) -> list[list[float]]:
    """Distinct cut points of each statistic over all rows; as many as :data:`CUT_SHARES` at most."""
    found = rows.agg(*[F.percentile_approx(F.col("x")[i], list(CUT_SHARES), 10_000).alias(f"c{i}") for i in range(len(STATISTICS))]).first()
    return [sorted(set(cuts or [])) for cuts in found]


@dataclass
class Moments:
    """Counts, feature sums and sums of feature products of good (0) and all (1) texts."""

    n: np.ndarray
    first: np.ndarray
    second: np.ndarray

    def __add__(self, other: Moments) -> Moments:
        return Moments(self.n + other.n, self.first + other.first, self.second + other.second)

    def mean(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        n = max(self.n[k], 1.0)
        return self.first[k] / n, self.second[k] / n


def moments(rows: DataFrame, blank: Scorer) -> list[Moments]:
    """Moments of the features in each half of the rows (x, good, half); one pass."""
    ship_by_value(sys.modules[__name__])
    d = len(blank.weights)

    def partial(batches):
        total = np.zeros((2, 2, 1 + d + d * d))
        for batch in batches:
            if batch.num_rows:
                phi = blank.features(matrix(batch.column(0)))
                good, half = (batch.column(k).to_numpy(zero_copy_only=False) for k in (1, 2))
                for h in (0, 1):
                    for k, at in ((0, good.astype(bool) & (half == h)), (1, half == h)):
                        f = phi[at]
                        total[h, k] += np.concatenate([[len(f)], f.sum(0), (f.T @ f).ravel()])
        return total.ravel()

    s = sum_vectors(rows.select("x", "good", "half"), partial)
    s = (np.zeros(4 * (1 + d + d * d)) if s is None else s).reshape(2, 2, -1)
    return [Moments(t[:, 0], t[:, 1:1 + d], t[:, 1 + d:].reshape(2, d, d)) for t in s]


def _loss(m: tuple[np.ndarray, np.ndarray], w: np.ndarray, sign: int) -> float:
    """Mean of ``(1 - sign * g)^2 / 4`` from first and second moments."""
    return float(1 - 2 * sign * (w @ m[0]) + w @ m[1] @ w) / 4


def against_all(m: Moments, l2: float) -> np.ndarray:
    """Weights of least squared loss of good against all texts, each weighing one half."""
    (good, good2), (all_, all2) = m.mean(0), m.mean(1)
    return np.linalg.solve((good2 + all2) / 2 + _ridge(len(good), l2), (good - all_) / 2)


def _ridge(d: int, l2: float) -> np.ndarray:
    ridge = np.full(d, l2 + 1e-9)
    ridge[0] = 1e-9  # the intercept is free
    return np.diag(ridge)


def non_negative_risk(m: Moments, prior: float, w: np.ndarray) -> tuple[float, float]:
    """Both terms of the risk, the second before it is held at zero."""
    return prior * _loss(m.mean(0), w, 1), _loss(m.mean(1), w, -1) - prior * _loss(m.mean(0), w, -1)


def minimise_risk(m: Moments, prior: float, l2: float, rounds: int = 60) -> np.ndarray:
    """Weights that minimise the non-negative risk with a ridge.

    ``max(0, bad)`` is the largest ``t * bad`` for ``t`` from 0 to 1, and for any
    such ``t`` the sum is a convex square, solved at once.  ``t`` is 1 where the
    second term stays positive, else the one that brings it to zero.
    """
    (good, good2), (all_, all2) = m.mean(0), m.mean(1)

    def solve(t: float) -> np.ndarray:
        h = (prior * (1 - t) * good2 + t * all2) / 2 + _ridge(len(good), l2)
        return np.linalg.solve(h, (prior * (1 + t) * good - t * all_) / 2)

    low, high = 0.0, 1.0
    w = solve(high)
    if non_negative_risk(m, prior, w)[1] >= 0:
        return w
    for _ in range(rounds):  # the second term falls as its weight grows
        t = (low + high) / 2
        low, high = (low, t) if non_negative_risk(m, prior, solve(t))[1] < 0 else (t, high)
    return solve(low)


def prior_of(good: np.ndarray, all_: np.ndarray, delta: float = 0.1) -> float:
    """Class prior from counts of good and of all texts by score bin (ascending): the ratio of the shares above
    the bin where the ratio's upper confidence bound is least."""
    n_good, n_all = good.sum(), all_.sum()
    if not n_good or not n_all:
        return 0.5
    q_good, q_all = good[::-1].cumsum() / n_good, all_[::-1].cumsum() / n_all
    some = q_good > 0
    slack = np.sqrt(np.log(4 / delta) / (2 * n_all)) + np.sqrt(np.log(4 / delta) / (2 * n_good))
    bound = np.where(some, (q_all + slack) / np.maximum(q_good, 1e-12), np.inf)
    k = int(bound.argmin())
    return float(np.clip(q_all[k] / q_good[k], 0.01, 0.99))


def score_counts(rows: DataFrame, scorers: list[Scorer]) -> np.ndarray:
    """Good (row 0) and all (row 1) texts of rows (x, good, half) by bin of their score; a half has its own scorer."""
    ship_by_value(sys.modules[__name__])

    def partial(batches):
        total = np.zeros((2, SCORE_BINS))
        for batch in batches:
            if batch.num_rows:
                x = matrix(batch.column(0))
                good, half = (batch.column(k).to_numpy(zero_copy_only=False) for k in (1, 2))
                score = np.where(half == 0, scorers[0].score(x), scorers[1].score(x))
                place = np.minimum((score * SCORE_BINS).astype(int), SCORE_BINS - 1)
                total += [np.bincount(place[good.astype(bool)], minlength=SCORE_BINS), np.bincount(place, minlength=SCORE_BINS)]
        return total.ravel()

    counts = sum_vectors(rows.select("x", "good", "half"), partial)
    return np.zeros((2, SCORE_BINS)) if counts is None else counts.reshape(2, SCORE_BINS)


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learnt from: CRC-32 of the id's text leaves one, divided by three."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def fit_quality(stats: DataFrame, positives: DataFrame, l2: float = 1e-3, prior_l2: float = 1e-2) -> tuple[Scorer, float]:
    """(scorer, class prior) from statistics (id, x) of all texts and the ids (column id) of trusted positives."""
    chosen = positives.where("id is not null").select("id").distinct().withColumn("good", F.lit(True))
    half = F.pmod(F.xxhash64("id", "x"), F.lit(2)).cast("int").alias("half")
    rows = materialize(stats.select("id", "x").join(chosen, "id", "left").select("x", F.coalesce("good", F.lit(False)).alias("good"), half), "risk")
    blank = Scorer.blank(statistic_cuts(rows))
    zero, one = moments(rows, blank)
    if not (zero + one).n[0]:
        return blank, 0.5
    prior = prior_of(*score_counts(rows, [Scorer(blank.cuts, against_all(m, prior_l2)) for m in (one, zero)]))
    return Scorer(blank.cuts, minimise_risk(zero + one, prior, l2)), prior


def quality_score(scorer: Scorer, x: Column) -> Column:
    """Column of probabilities that a text is good, from its statistics."""
    ship_by_value(sys.modules[__name__])

    @F.pandas_udf("double")
    def score(x: pd.Series) -> pd.Series:
        return pd.Series(scorer.score(np.array(x.tolist(), float)) if len(x) else [], dtype=float)

    return score(x)


def op12_quality(spark, sf_dir) -> DataFrame:
    """Quality score of every document, learnt from good labels that are not held out and all texts."""
    stats = with_statistics(read_table(spark, sf_dir, "documents"))
    labels = read_table(spark, sf_dir, "labels")
    good = labels.where((F.col("quality") == 1) & ~held_out(F.col("doc_id"))).select(F.col("doc_id").alias("id"))
    scorer, _ = fit_quality(stats, good)
    scored = stats.select(F.col("id").alias("doc_id"), quality_score(scorer, F.col("x")).alias("score"))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
