"""Quality rules: a decision list learnt by sequential covering.

Statistics of every text are computed once; labelled rows of a bounded sample
(``max_fit_rows``) teach an ordered list of threshold conjunctions, each grown
by FOIL's gain on two thirds of the rows, pruned on the rest, and kept while it
is precise there.  A sampled row weighs as many labels as it stands for, so
precision is that over all labels whatever the sample's mix.  The list is emitted as one Spark conditional expression over
the statistics, so its verdicts can be read and run anywhere.

Defined results: a null or empty text has no words, so all counts are 0 and the
base rule fails it; repeated rows repeat; labels that are null or other than 0
and 1 are not learnt from; without labels of both kinds the list is empty and
keeps what the base rule keeps; an empty table yields no rows.  Other columns
are not read, so their names cannot clash.
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
from classbench.llm.toxicity import labelled_sample
from classbench.session import ship_by_value

SYMBOLS = "#*$%&|<>"
SPACES = b" \t\n\x0b\x0c\r"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_digits",
          "n_marks", "n_chars")
#: What rules may test: SQL over the counts.
FEATURES = {
    "n_words": "n_words",
    "mean_word_chars": "word_chars / greatest(n_words, 1)",
    "symbols_per_word": "n_symbols / greatest(n_words, 1)",
    "dup_line_share": "n_dup_lines / greatest(n_lines, 1)",
    "repeat_word_share": "n_repeat_words / greatest(n_words, 1)",
    "upper_share": "n_upper / greatest(word_chars, 1)",
    "digit_share": "n_digits / greatest(word_chars, 1)",
    "marks_per_word": "n_marks / greatest(n_words, 1)",
    "words_per_line": "n_words / greatest(n_lines, 1)",
}


def text_counts(text: str | None) -> tuple[int, ...]:
    """The counts of one text, in the order of :data:`COUNTS`."""
    text = text or ""
    raw = text.encode()
    words = raw.split()  # ASCII white space, as the word definition has it
    n = len(words)
    repeated = 0
    if n >= 4:
        windows = list(zip(words, words[1:], words[2:]))
        if len(set(windows)) < len(windows):
            many, last = Counter(windows), -1
            for i, w in enumerate(windows):
                if many[w] > 1:
                    repeated += i + 3 - max(i, last)
                    last = i + 3
    lines = [x for x in raw.split(b"\n") if x.split(None, 1)]
    spaces = sum(map(raw.count, (SPACES[i:i + 1] for i in range(len(SPACES)))))
    return (n, len(text) - spaces, sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeated, len(lines),
            len(raw) - len(raw.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ")),
            len(raw) - len(raw.translate(None, b"0123456789")), text.count("!") + text.count("?"), len(text))


def with_counts(docs: DataFrame, text_col: str = "text") -> Column:
    """Struct column of the counts of a text column."""
    ship_by_value(sys.modules[__name__])

    @F.pandas_udf(", ".join(f"{c} long" for c in COUNTS))
    def counts(text: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([text_counts(t) for t in text], columns=list(COUNTS), dtype="int64")

    return counts(docs[text_col])


@dataclass(frozen=True)
class Rule:
    """A conjunction of (feature, at_least, threshold) tests that rejects."""

    tests: tuple[tuple[str, bool, float], ...]

    def covers(self, x: dict[str, np.ndarray]) -> np.ndarray:
        hit = np.ones(len(next(iter(x.values()))), bool)
        for name, at_least, t in self.tests:
            hit &= x[name] >= t if at_least else x[name] < t
        return hit

    def sql(self) -> str:
        return " and ".join(f"({FEATURES[f]}) {'>=' if up else '<'} {t!r}D" for f, up, t in self.tests)


def _grow(x: dict[str, np.ndarray], bad: np.ndarray, weight: np.ndarray, thresholds: dict[str, np.ndarray], banned: set, longest: int = 4) -> Rule:
    """Add the test of the highest FOIL gain until no good row is covered; ``banned`` tests do not start a rule."""
    tests: list[tuple[str, bool, float]] = []
    inside = np.ones(len(bad), bool)
    while len(tests) < longest:
        p0, n0 = weight[inside & bad].sum(), weight[inside & ~bad].sum()
        if not p0 or not n0:
            break
        best, pick = 1e-9, None
        for f, cuts in thresholds.items():
            value = x[f][inside]
            is_bad, w = bad[inside], weight[inside]
            place = np.searchsorted(cuts, value, "right")  # cuts at or below the value
            pos = np.bincount(place[is_bad], w[is_bad], len(cuts) + 1)
            neg = np.bincount(place[~is_bad], w[~is_bad], len(cuts) + 1)
            for up in (True, False):
                if not tests and (f, up) in banned:
                    continue
                p = pos[::-1].cumsum()[::-1][1:] if up else pos.cumsum()[:-1]
                n = neg[::-1].cumsum()[::-1][1:] if up else neg.cumsum()[:-1]
                gain = p * (np.log2((p + 1e-9) / (p + n + 1e-9) + 1e-12) - np.log2(p0 / (p0 + n0)))
                gain[p == 0] = -1
                k = int(gain.argmax()) if len(gain) else -1
                if k >= 0 and gain[k] > best:
                    best, pick = gain[k], (f, up, float(cuts[k]))
        if not pick:
            break
        tests.append(pick)
        inside = Rule(tuple(tests)).covers(x)
    return Rule(tuple(tests))


def _prune(rule: Rule, x: dict[str, np.ndarray], bad: np.ndarray, weight: np.ndarray) -> Rule:
    """Drop final tests while (p - n) / (p + n) on the pruning rows does not fall."""
    def worth(r):
        hit = r.covers(x)
        p, n = weight[hit & bad].sum(), weight[hit & ~bad].sum()
        return (p - n) / (p + n) if p + n else -1.0
    best, value = rule, worth(rule)
    for k in range(len(rule.tests) - 1, 0, -1):
        shorter = Rule(rule.tests[:k])
        if worth(shorter) >= value:
            best, value = shorter, worth(shorter)
    return best


def learn_rules(rows: pd.DataFrame, precision: float = 0.995, most_rules: int = 12, cuts: int = 64) -> list[Rule]:
    """Ordered rejecting rules from a frame of features, ``label`` (1 good, 0 bad) and maybe ``weight`` (else all 1)."""
    if not len(rows) or rows["label"].nunique() < 2:
        return []
    x = {f: rows[f].to_numpy(float) for f in FEATURES}
    bad = (rows["label"] == 0).to_numpy()
    weight = rows["weight"].to_numpy(float) if "weight" in rows else np.ones(len(rows))
    for_pruning = np.arange(len(rows)) % 3 == 0
    thresholds = {}
    for f, v in x.items():  # midpoints between neighbouring quantiles, so that values on either side are apart
        q = np.unique(np.quantile(v, np.linspace(0, 1, cuts)))
        q = np.unique(np.concatenate([q, np.quantile(v[bad], np.linspace(0, 1, cuts)) if bad.any() else []]))
        thresholds[f] = (q[1:] + q[:-1]) / 2
    rules, left, banned = [], np.ones(len(rows), bool), set()
    sub = lambda at: {f: v[at] for f, v in x.items()}
    while len(rules) < most_rules:
        grow, prune = left & ~for_pruning, left & for_pruning
        if not (bad & grow).any():
            break
        rule = _grow(sub(grow), bad[grow], weight[grow], thresholds, banned)
        if not rule.tests:
            break
        choices = [_prune(rule, sub(prune), bad[prune], weight[prune]), rule]
        hits = [r.covers(x) for r in choices]
        good = [i for i, h in enumerate(hits) if (h & left & bad).any()
                and weight[h & left & bad].sum() >= precision * weight[h & left].sum()
                and weight[h & bad].sum() >= precision * weight[h].sum()]
        if not good:  # not precise over all rows: no rule may start like this one
            banned.add(rule.tests[0][:2])
            continue
        rules.append(choices[good[0]])
        left &= ~hits[good[0]]
    return rules


def decision_list(rules: list[Rule]) -> Column:
    """The rules as one conditional expression over the counts: true keeps."""
    kept = F.lit(True)
    for rule in reversed(rules):
        kept = F.when(F.expr(rule.sql()), F.lit(False)).otherwise(kept)
    return kept


def judge_quality(docs: DataFrame, labels: DataFrame, text_col: str = "text", max_fit_rows: int = 20_000) -> tuple[DataFrame, list[Rule]]:
    """(doc_id, counts, base_failed, kept) of every row of ``docs``, and the rules that were learnt."""
    rows = materialize(docs.select("doc_id", with_counts(docs, text_col).alias("s")).select("doc_id", "s.*"), "quality")
    chosen = F.broadcast(labelled_sample(labels, "quality", max_fit_rows))  # max_fit_rows rows of three numbers
    fit = rows.join(chosen, "doc_id").select(
        "doc_id", "label", "weight", *[F.expr(e).cast("double").alias(f) for f, e in FEATURES.items()]).toPandas()
    rules = learn_rules(fit.sort_values(["doc_id", *FEATURES, "label"]).reset_index(drop=True))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    judged = rows.withColumn("base_failed", failed).withColumn("kept", ~failed & decision_list(rules))
    return judged, rules


def op4_quality(spark, sf_dir) -> DataFrame:
    """Counts and verdict of every document."""
    judged, _ = judge_quality(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
