"""Spelling variants: words one edit apart, found by pivotal grams, grouped under their commonest spelling.

Bigrams are ordered from rare to common by their number of words.  A word's
*prefix* is its three rarest bigrams (and all as rare as the third); its two
*pivots* are disjoint bigrams of the prefix of least total frequency, chosen by
dynamic programming.  One edit spoils at most one of two disjoint pivots, so of
two near words the one whose prefix ends earlier in the order has a pivot that
stands in the other's prefix.  Around that pivot the single edit lies on one
side and the other side is whole.  That gives the position limit: with the edit
to the right the pivot keeps its place and the head up to it is equal, with the
edit to the left it keeps its distance from the end (its place moves by the
difference in length, at most one) and the tail from it is equal.  Pivots are
therefore looked up by that head or tail and the other word's length, which no
pair outside the limit meets; words that meet and differ in more than four of 64
bits that stand for their bigrams cannot be near, and the others are verified by
their edit distance.

The frequency table has a fixed number of hashed bigrams, whatever the alphabet
and the corpus; it is the only thing sent to all tasks.  A word has no more near
words than its alphabet allows, so links grow with the words.

Defined results: null texts hold no runs, a null id counts as empty text; words
that repeat are added up; an empty table yields no rows; ties for the commonest
near word go to the smallest in code-point order.  Other columns are not read,
so their names cannot clash.
"""

from __future__ import annotations

import math
import sys
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from classbench.llm.common import materialize, read_table
from classbench.session import ship_by_value

#: Letters of a run: A to Z, a to z and the second half of Latin-1's upper block.
RUN = "[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Hashed bigrams of the frequency table.
GRAM_SLOTS = 1 << 16
#: Edits that near words differ by; a prefix has 2 * EDITS + 1 bigrams, a word EDITS + 1 pivots.
EDITS = 1


def gram_slot(gram: str) -> int:
    return zlib.crc32(gram.encode("utf-8", "surrogatepass")) % GRAM_SLOTS


def pivots(places: list[int], cost: list[int]) -> list[int]:
    """The ``EDITS + 1`` pairwise disjoint bigram places of least total cost, by dynamic programming.

    ``best[k][i]``: least cost of ``k`` disjoint bigrams among the first ``i``
    places (ascending), with the choice that gave it.  Empty if there are too few.
    """
    n, need = len(places), EDITS + 1
    best = [[(0, ())] * (n + 1)] + [[(math.inf, ())] * (n + 1) for _ in range(need)]
    for i in range(n):
        clear = i
        while clear and places[clear - 1] > places[i] - 2:  # places that overlap this bigram
            clear -= 1
        for k in range(1, need + 1):
            value, chosen = best[k - 1][clear]
            best[k][i + 1] = min(best[k][i], (value + cost[i], (*chosen, places[i])))
    value, chosen = best[need][n]
    return list(chosen) if value < math.inf else []


def signature(word: str, order: np.ndarray, frequency: np.ndarray) -> tuple[int, list[int], list[int]]:
    """(order of the prefix's last bigram, places of the prefix, places of the pivots) of a word."""
    slots = [gram_slot(word[i:i + 2]) for i in range(len(word) - 1)]
    rank = [int(order[s]) for s in slots]
    last = sorted(rank)[min(2 * EDITS, len(rank) - 1)]
    prefix = [i for i, r in enumerate(rank) if r <= last]
    return last, prefix, pivots(prefix, [int(frequency[slots[i]]) for i in prefix])


def gram_bits(word: str) -> int:
    """The word's bigrams as bits of a signed long; one edit takes away and adds at most two bigrams each."""
    bits = 0
    for i in range(len(word) - 1):
        bits |= 1 << (gram_slot(word[i:i + 2]) & 63)
    return bits - (1 << 64) if bits >> 63 else bits


def _index(frequency: np.ndarray, of_pivots: bool, schema: pa.Schema):
    """Arrow function: rows (key, size, word, n, last, grams) of all words' pivots, or of their prefixes."""
    order = np.empty(GRAM_SLOTS, np.int64)
    order[np.argsort(frequency, kind="stable")] = np.arange(GRAM_SLOTS)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for word, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                last, prefix, pivot = signature(word, order, frequency)
                grams = gram_bits(word)
                sizes = range(len(word) - EDITS, len(word) + EDITS + 1) if of_pivots else (len(word),)
                for i in pivot if of_pivots else prefix:
                    for key in (f"<{word[:i + 2]}", f">{word[i:]}"):
                        rows += [(key, size, word, n, last, grams) for size in sizes]
            columns = list(zip(*rows)) if rows else [()] * len(schema)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return index


def gram_frequency(words: DataFrame) -> np.ndarray:
    """Words that hold each hashed bigram; ``GRAM_SLOTS`` numbers."""
    grams = F.array_distinct(F.transform(F.sequence(F.lit(1), F.length("word") - 1), lambda i: F.substring(F.col("word"), i, F.lit(2))))
    rows = words.where(F.length("word") > 1).select(F.explode(grams).alias("gram")).groupBy(
        (F.crc32(F.encode("gram", "utf-8")) % GRAM_SLOTS).alias("slot")).agg(F.count("*").alias("c")).collect()
    frequency = np.zeros(GRAM_SLOTS, np.int64)
    for r in rows:
        frequency[r["slot"]] = r["c"]
    return frequency


def near_words(words: DataFrame) -> DataFrame:
    """(word, n, near, near_n): all ordered pairs of words exactly one edit apart; ``words`` has (word, n), words
    distinct and of at least four code points."""
    ship_by_value(sys.modules[__name__])
    frequency = gram_frequency(words)
    schema = pa.schema([("key", pa.string()), ("size", pa.int32()), ("word", pa.string()), ("n", pa.int64()), ("last", pa.int64()), ("grams", pa.int64())])
    ddl = "key string, size int, word string, n long, last long, grams long"
    table = words.select("word", "n")
    own = table.mapInArrow(_index(frequency, True, schema), ddl)
    other = table.mapInArrow(_index(frequency, False, schema), ddl).withColumnsRenamed({"word": "near", "n": "near_n", "last": "near_last", "grams": "near_grams"})
    met = own.join(other, ["key", "size"]).where(f"last <= near_last and bit_count(grams ^ near_grams) <= {4 * EDITS} and word <> near")
    links = met.where(F.levenshtein("word", "near", EDITS) == EDITS).select("word", "n", "near", "near_n")
    both = links.union(links.select("near", "near_n", "word", "n"))
    return both.distinct()


def follow(forms: DataFrame) -> DataFrame:
    """(word, root): the last word reached from each word of (word, form, n) by following forms.

    Counts grow along the way, by a factor each step, so the depth is at most
    the logarithm of the largest count; each round doubles the steps taken.
    """
    most = forms.agg(F.max("n").alias("most")).first()["most"]
    steps = materialize(forms.select("word", F.col("form").alias("root")), "roots")
    for _ in range(math.ceil(math.log2(max(2.0, math.log2(max(2, most or 0)) + 1)))):
        onward = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        steps = materialize(steps.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "roots")
    return steps


def group_variants(words: DataFrame, times: int = 5) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of distinct words with their counts (word, n).

    ``form`` is the commonest near word if it occurs at least ``times`` (2 or
    more) as often, else null; ``root`` the end of the chain of forms.
    """
    if times < 2:
        raise ValueError("times must be at least 2, so that forms lead to ever commoner words")
    words = materialize(words.select("word", "n"), "words")
    near = near_words(words).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form"))).alias("best"))
    common = -F.col("best.less")
    kept = F.when(common >= times * F.col("n"), F.col("best.form"))
    formed = materialize(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), kept.alias("form"),
        F.when(kept.isNotNull(), common).alias("form_n")), "forms")
    roots = follow(formed.where("form is not null"))
    return formed.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def lower_ascii(text: Column) -> Column:
    """A to Z lower-cased, other letters as they are."""
    return F.when(text.rlike("[A-Z]"), F.translate(text, UPPER, LOWER)).otherwise(text)


def letter_runs(docs: DataFrame, least: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, run): every maximal run of letters of at least ``least`` code points, A to Z lower-cased."""
    runs = F.regexp_extract_all(F.coalesce(text_col, F.lit("")), F.lit(f"{RUN[:-1]}{{{least},}}"), F.lit(0))
    return docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"),
                       F.explode(F.transform(runs, lower_ascii)).alias("run"))


def count_words(words: DataFrame, least_n: int) -> DataFrame:
    """(word, n) of the words (column word) that occur at least ``least_n`` times."""
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_n)


#: Fixed values of op11's stated noise, word length and least count.
NOISE, LEAST_LENGTH, LEAST_COUNT, TIMES = 199, 6, 5, 5


def op11_variants(spark, sf_dir) -> DataFrame:
    """Variant groups of the words of all documents, one run in 199 (by hash) having lost a letter."""
    runs = letter_runs(read_table(spark, sf_dir, "documents"), LEAST_LENGTH)  # losing a letter only shortens
    h = F.crc32(F.encode(F.concat_ws(":", "id", "run"), "utf-8"))
    at = (h % F.length("run")).cast("int")
    shorter = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    word = F.when(h % NOISE == 0, shorter).otherwise(F.col("run"))
    # through a generator, so that the filter and the counts read one column instead of making each word again
    words = runs.select(F.explode(F.array(word)).alias("word")).where(F.length("word") >= LEAST_LENGTH)
    return group_variants(count_words(words, LEAST_COUNT), TIMES)
