"""Periodic runs of words, found on a Re-Pair grammar of each text.

Re-Pair replaces the commonest pair of neighbouring symbols by a new
nonterminal until no pair occurs twice, so a repeated passage becomes one rule.
A run (a maximal stretch whose words recur ``q`` words later) lies whole in the
expansion of some symbol or of the start rule and crosses a boundary of that
rule.  Runs that cross a rule's boundary are computed once for the rule, on one
of its expansions, however often it is used; the rule's runs are translated to
all places where the derivation has it, and intervals of one period that share
a period are merged to maximal ones.

At a boundary, a run of ``shortest`` words and ``times`` periods repeats the
five words around the boundary at the distance of its period, to the right or
to the left (three periods in 24 words or more leave at least four words after
the shift on the longer side).  Only those distances are tried, and each is
extended both ways word by word, so nothing depends on hashing.

A text in which no 16 words occur twice (``2/3 * shortest``: the words a run
shares with itself one period on) has no run; no grammar is built for it.

Defined results: a null or empty text has no words and no runs, and an empty
collapsed text; repeated rows and ids repeat; an empty table yields no rows.
Texts are taken whole; memory is in proportion to the longest one.  Other
columns are not read, so their names cannot clash.
"""

from __future__ import annotations

import heapq
import sys
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from classbench.llm.common import let, plain_words, read_table
from classbench.session import ship_by_value

#: Fixed values of a run: least words and least periods.
SHORTEST, TIMES = 24, 3
#: Words around a boundary that recur one period on (see the module's text).
AROUND = 5
_FOUND = [StructField("runs", ArrayType(StructType([StructField(c, LongType()) for c in ("start", "length", "period")]))),
          StructField("collapsed", StringType())]


def re_pair(ids: list[int], first_new: int) -> tuple[list[int], list[int], list[tuple[int, int]]]:
    """(start rule, text position of each of its symbols, rules): rule ``k`` is symbol ``first_new + k``.

    Symbols below ``first_new`` are words.  Pairs are taken by falling count,
    older ones first among equals; occurrences of a pair do not overlap.
    """
    n = len(ids)
    symbol, after, before = list(ids), list(range(1, n + 1)), list(range(-1, n - 1))
    places: dict[tuple[int, int], list[int]] = defaultdict(list)
    for i in range(n - 1):
        places[ids[i], ids[i + 1]].append(i)
    heap = [(-len(p), k, pair) for k, (pair, p) in enumerate(places.items()) if len(p) > 1]
    heapq.heapify(heap)
    born, rules = len(heap), []
    while heap:
        count, age, pair = heapq.heappop(heap)
        left, right = pair
        alive = [i for i in sorted(set(places[pair])) if symbol[i] == left and after[i] < n and symbol[after[i]] == right]
        held, last = [], -1
        for i in alive:  # without overlaps
            if i != last:
                held.append(i)
                last = after[i]
        if len(held) < 2:
            del places[pair]
            continue
        if len(held) < -count:  # fewer than when it was queued: back to its place in the order
            places[pair] = alive
            heapq.heappush(heap, (-len(held), age, pair))
            continue
        new = first_new + len(rules)
        rules.append(pair)
        touched = defaultdict(list)
        for i in held:
            j = after[i]
            k = after[j]
            symbol[i], symbol[j], after[i] = new, -1, k
            if k < n:
                before[k] = i
                touched[new, symbol[k]].append(i)
            if before[i] >= 0:
                touched[symbol[before[i]], new].append(before[i])
        del places[pair]
        for q, at in touched.items():
            places[q] = at
            if len(at) > 1:
                heapq.heappush(heap, (-len(at), born, q))
                born += 1
    start = []
    i = 0
    while i < n:
        start.append(i)
        i = after[i]
    return [symbol[i] for i in start], start, rules


def _agree(words: np.ndarray, i: int, j: int, most: int, step: int) -> int:
    """How many words from ``i`` and from ``j`` on (``step`` 1) or back (-1) agree, at most ``most``."""
    done, size = 0, 16
    while done < most:
        size = min(size, most - done)
        if step > 0:
            differ = words[i + done:i + done + size] != words[j + done:j + done + size]
        else:
            differ = words[i - done - size + 1:i - done + 1][::-1] != words[j - done - size + 1:j - done + 1][::-1]
        at = int(differ.argmax())
        if differ[at]:
            return done + at
        done, size = done + size, 4 * size
    return done


class _Windows:
    """Places of equal windows of ``AROUND`` words (equal hashes: a candidate, which is then compared)."""

    def __init__(self, words: np.ndarray):
        name = np.zeros(max(len(words) - AROUND + 1, 0), np.uint64)
        mixed = (words.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
        for k in range(AROUND):
            name = name * np.uint64(0xBF58476D1CE4E5B9) + mixed[k:k + len(name)]
        self.order = np.argsort(name, kind="stable")
        self.name, self.sorted = name, name[self.order]

    def others(self, place: int, low: int, high: int) -> list[int]:
        """Places of the window at ``place`` from ``low`` up to, not including, ``high``."""
        if not 0 <= place < len(self.name):
            return []
        a, b = np.searchsorted(self.sorted, self.name[place], "left"), np.searchsorted(self.sorted, self.name[place], "right")
        group = self.order[a:b]  # ascending, as the sort is stable
        return group[np.searchsorted(group, low):np.searchsorted(group, high)].tolist()


def crossing_runs(words: np.ndarray, windows: _Windows, x: int, b: int, y: int, shortest: int, times: int) -> list[tuple[int, int, int]]:
    """(start, end, period) of the runs of ``words[x:y]`` that cross its boundary before ``b``, maximal there."""
    widest = (y - x) // times
    distances = {p - (b - 1) for p in windows.others(b - 1, b, b + widest)}
    distances |= {b - AROUND + 1 - p for p in windows.others(b - AROUND + 1, max(x, b - AROUND + 1 - widest), b - AROUND + 1)}
    found: list[tuple[int, int, int]] = []
    for q in sorted(distances):
        # a stretch with words one period after the boundary's left word, and one with words a period before its right word
        for left in {i for i in (b - 1, b - q) if x <= i and i + q < y and words[i] == words[i + q]}:
            if any(q % p == 0 and s <= left and left + q < e for s, e, p in found):
                continue  # a multiple of a period found here: the same stretch
            start = left - _agree(words, left - 1, left + q - 1, left - x, -1)
            end = left + q + _agree(words, left, left + q, y - left - q, 1)
            if start < b < end and end - start >= max(shortest, times * q):
                found.append((start, end, q))
    return found


def merged(intervals: set[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Maximal (start, end, period): intervals of one period that share a period are one, and of one stretch's
    periods the smallest stays."""
    by_period: dict[int, list[tuple[int, int]]] = defaultdict(list)
    for s, e, q in intervals:
        by_period[q].append((s, e))
    least: dict[tuple[int, int], int] = {}
    for q, parts in by_period.items():
        parts.sort()
        joined = [list(parts[0])]
        for s, e in parts[1:]:
            if s <= joined[-1][1] - q:
                joined[-1][1] = max(joined[-1][1], e)
            else:
                joined.append([s, e])
        for s, e in joined:
            least[s, e] = min(q, least.get((s, e), q))
    return sorted((s, e, q) for (s, e), q in least.items())


def find_runs(words: list, shortest: int = SHORTEST, times: int = TIMES) -> list[tuple[int, int, int]]:
    """(start, end, period) of every run of a sequence, by start, then period.

    The five words around a boundary suffice for 24 words and three periods or more.
    """
    if shortest < SHORTEST or times < TIMES:
        raise ValueError(f"runs need at least {SHORTEST} words and {TIMES} periods")
    n = len(words)
    if n < shortest:
        return []
    names: dict = {}
    ids = [names.setdefault(w, len(names)) for w in words]
    if not _repeats(ids, shortest - shortest // times):
        return []
    text = np.array(ids, np.int64)
    windows = _Windows(text)
    start, position, rules = re_pair(ids, len(names))
    first_new = len(names)
    size = [1] * first_new
    for left, right in rules:
        size.append(size[left] + size[right])
    of_rule: dict[int, list[tuple[int, int, int]]] = {}
    intervals: set[tuple[int, int, int]] = set()
    for k, at in enumerate(position):  # boundaries of the start rule, whose expansion is the text
        if k:
            intervals.update(crossing_runs(text, windows, 0, at, n, shortest, times))
    stack = [(s, at) for s, at in zip(start, position) if size[s] >= shortest]
    while stack:
        s, at = stack.pop()
        left, right = rules[s - first_new]
        middle = at + size[left]
        if s not in of_rule:  # once for each rule, where it stands first; relative to its start
            of_rule[s] = [(a - at, e - at, q) for a, e, q in
                          crossing_runs(text, windows, at, middle, at + size[s], shortest, times)]
        intervals.update((at + a, at + e, q) for a, e, q in of_rule[s])
        stack += [(c, p) for c, p in ((left, at), (right, middle)) if size[c] >= shortest]
    return merged(intervals)


def _repeats(ids: list[int], length: int) -> bool:
    """Whether ``length`` words occur twice (equal hashes count as equal: no repeat is missed)."""
    if len(ids) <= length:
        return False
    x = (np.array(ids, np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(31)
    done = 1
    while done < length:  # windows of doubled length, and the last overlapping the one before
        step = min(done, length - done)
        x = x[:len(x) - step] * np.uint64(0xBF58476D1CE4E5B9) + (x[step:] ^ (x[step:] >> np.uint64(27)))
        done += step
    x.sort()
    return bool((x[1:] == x[:-1]).any())


def collapsed(words: list, runs: list[tuple[int, int, int]]) -> list:
    """The words without those that stand in a run after its first period."""
    if not runs:
        return words
    mark = np.zeros(len(words) + 1, np.int64)
    for s, e, q in runs:
        mark[s + q] += 1
        mark[e] -= 1
    keep = np.cumsum(mark[:-1]) == 0
    return [w for w, k in zip(words, keep.tolist()) if k]


def text_runs(docs: DataFrame, shortest: int = SHORTEST, times: int = TIMES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, runs, collapsed) for each row of ``docs``: its runs as an array of (start, length, period), by start,
    then period, and the text without the words that repeat a period, single spaces between words."""
    ship_by_value(sys.modules[__name__])
    if shortest < SHORTEST or times < TIMES:
        raise ValueError(f"runs need at least {SHORTEST} words and {TIMES} periods")
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs, kept = [], []
            for text in batch.column(1):  # one text at a time
                words = (text.as_py() or "").encode().split()  # bytes: ASCII white space alone
                found = find_runs(words, shortest, times)
                runs.append([{"start": s, "length": e - s, "period": q} for s, e, q in found])
                kept.append(b" ".join(collapsed(words, found)).decode())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(runs, pa.list_(run)), pa.array(kept, pa.string())],
                                             [id_col, "runs", "collapsed"])

    return docs.select(id_col, text_col).mapInArrow(judge, StructType([docs.schema[id_col], *_FOUND]))


def edited_words(doc_id: Column, text: Column) -> Column:
    """op13's stated change: where the id's CRC-32 is divisible by ten, the words from one place on repeat a period."""
    h = F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
    g = F.floor(h / 10).cast("long")

    def change(words: Column) -> Column:
        n = F.size(words).cast("long")
        a = F.when(n > 0, g % n)
        plan = F.struct(a.alias("a"), (1 + F.floor((n - a) / (3 + g % 8))).alias("p"))
        again = lambda z: F.transform(words, lambda w, i: F.when(i < z["a"], w).otherwise(
            F.get(words, (z["a"] + (i - z["a"]) % z["p"]).cast("int"))))
        return F.array_join(let(plan, again), " ")

    return F.when((h % 10 == 0) & text.isNotNull(), let(plain_words(text), change)).otherwise(text)


def op13_runs(spark, sf_dir) -> DataFrame:
    """Runs of the words of every document, one document in ten (by hash) made periodic from some word on."""
    docs = read_table(spark, sf_dir, "documents")
    found = text_runs(docs.select("doc_id", edited_words(F.col("doc_id"), F.col("text")).alias("text")))
    # exact exponents are compared as length * other period; ties: first start, then period (the array's order)
    top = F.expr("aggregate(runs, cast(null as struct<start:bigint,length:bigint,period:bigint>), "
                 "(best, r) -> if(best is null or r.length * best.period > best.length * r.period, r, best))")
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    best = found.withColumn("top", top)
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("top.start").alias("start"), F.col("top.length").alias("length"),
        F.col("top.period").alias("period"), F.floor(1000 * F.col("top.length") / F.col("top.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"), F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"))
