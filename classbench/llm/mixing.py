"""Mixing sources to target weights by pivotal dependent rounding (native).

Every document of a source gets the same expected number of copies, the source's
target over its size.  The whole part is certain; the fractional parts are
rounded together: two fractions are paired and mass moves from one to the other
at random until one of them is 0 or 1.  Blocks of a source's documents are
rounded first, what is left of each block (one fraction) goes to the next level
of the tree, and so on, so that a source's words hardly move and no task holds
more than a block.  All randomness is hashed from the ids: reruns agree.

Defined results: null texts have size 0; a null source is a source of its own
and the last one; rows that repeat an id, source and size are one unit and get
the same copies; documents of size 0 take no words; an empty table yields no
rows; other columns are not read, so their names cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from classbench.llm.common import fresh, long_array, materialize, read_table, word_count

#: Documents of a block; a block is rounded by one fold over its array.
BLOCK = 256
#: Size classes of a source, by size over the source's mean: limits, largest first.
CLASSES = (4.0, 1.0, 0.25)
#: Fractions this close to 0 or 1 are that.
EPSILON = 1e-9


def ranked(df: DataFrame, order: Column, name: str) -> DataFrame:
    """``df`` with its 0-based position by ``order``: ranges are sorted apart and their sizes added up."""
    dealt = materialize(df.repartitionByRange(order).sortWithinPartitions(order).withColumn(
        "_range", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id()), "ranked")
    sizes = {r["_range"]: r["n"] for r in dealt.groupBy("_range").agg(F.count("*").alias("n")).collect()}  # a row a partition
    before, total = [], 0
    for k in range(max(sizes, default=-1) + 1):
        before.append(total)
        total += sizes.get(k, 0)
    start = F.get(long_array(before), F.col("_range")) if before else F.lit(0)
    position = start + F.col("_at") - F.shiftleft(F.col("_range").cast("long"), 33)
    return dealt.withColumn(name, position).drop("_range", "_at")


def source_targets(units: DataFrame, weights: tuple[float, ...], cap: float) -> DataFrame:
    """(src, source, source_size, docs, target) from units (source, size, times).

    Weights repeat over the sources in code point order; a level ``x`` is raised
    until the targets ``min(cap * size, x * weight)`` share out all sizes.
    """
    sizes = units.groupBy("source").agg(F.sum(F.col("size") * F.col("times")).alias("source_size"), F.sum("times").alias("docs"))
    table = materialize(ranked(sizes, F.asc_nulls_last("source"), "src").withColumn(
        "weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("src") % len(weights) + 1).cast("int"))), "sources")
    level, capped = 0.0, -1
    while True:
        over = F.col("weight") * F.lit(level) > cap * F.col("source_size")
        row = table.agg(F.sum("source_size").alias("all"), F.count_if(over).alias("capped"),
                        F.sum(F.when(over, cap * F.col("source_size")).otherwise(0.0)).alias("held"),
                        F.sum(F.when(over, 0.0).otherwise(F.col("weight"))).alias("free")).first()
        if row["capped"] == capped or not row["free"]:
            break
        capped, level = row["capped"], ((row["all"] or 0) - row["held"]) / row["free"]
    return table.select("src", "source", "source_size", "docs", F.least(
        F.col("weight") * F.lit(level), cap * F.col("source_size")).alias("target"))


def _uniform(*parts: str) -> str:
    return f"(shiftrightunsigned(xxhash64({', '.join(parts)}), 11) / 9007199254740992.0D)"


def _round_blocks(rows: DataFrame, level: int, seed: int) -> DataFrame:
    """One level of the tree: rows (src, block, words, key, p, unit) in; the same rows with their rounded
    ``p``, at most one of a block still fractional.

    A fold carries one fraction through the block, from large documents to
    small ones.  Words move between it and the next fraction, up for one and
    down for the other, until one of the two is 0 or 1; which way is drawn so
    that no expectation changes.
    """
    items = "array_sort(collect_list(named_struct('order', -words, 'key', key, 'words', words, 'p', p, 'unit', unit)))"
    blocks = rows.groupBy("src", "block").agg(F.expr(items).alias("a"))
    u = _uniform(f"{seed}L", f"{level}L", "a[acc.i].key", "x.key")
    # words that the carried fraction can take from the next one, or give to it
    room = ("named_struct('up', least((1 - acc.p) * acc.w, x.p * x.words), 'down', least(acc.p * acc.w, (1 - x.p) * x.words))")
    move = f"if(r.up + r.down > 0 and {u} < r.down / (r.up + r.down), r.up, -r.down)"
    whole = f"if(v < {EPSILON}D, 0.0D, if(v > 1 - {EPSILON}D, 1.0D, v))"
    snap = lambda value: f"get(transform(array({value}), v -> {whole}), 0)"
    moved = f"named_struct('c', {snap('acc.p + d / acc.w')}, 'x', {snap('x.p - d / x.words')})"
    state = "named_struct('i', {i}, 'w', {w}, 'p', {p}, 'n', acc.n + 1, 'ones', {ones})".format
    settled = state(i="acc.n", w="x.words", p="q.x", ones="if(q.c = 1, array_append(acc.ones, acc.i), acc.ones)")
    carried = state(i="acc.i", w="acc.w", p="q.c", ones="if(q.x = 1, array_append(acc.ones, acc.n), acc.ones)")
    step = (f"get(transform(array({room}), r -> get(transform(array({move}), d -> get(transform(array({moved}), "
            f"q -> if(q.c = 0 or q.c = 1, {settled}, {carried})), 0)), 0)), 0)")
    first = state(i="0", w="x.words", p="x.p", ones="acc.ones")
    start = "named_struct('i', 0, 'w', 0.0D, 'p', 0.0D, 'n', 0, 'ones', cast(array() as array<int>))"
    folded = blocks.withColumn("f", F.expr(f"aggregate(a, {start}, (acc, x) -> if(acc.n = 0, {first}, {step}))"))
    rounded = F.expr("transform(a, (x, i) -> named_struct('words', x.words, 'key', x.key, 'p', "
                     "if(array_contains(f.ones, i), 1.0D, if(i = f.i, f.p, 0.0D)), 'unit', x.unit))")
    return folded.select("src", F.inline(rounded))


def round_fractions(rows: DataFrame, seed: int) -> DataFrame:
    """(unit, one): whether each unit's fraction ``p`` became 1; rows are (src, words, key, p, unit)."""
    settled, waiting, level = [], rows, 0
    while True:
        # written first: its size is then known, and a short list of sources does not deal the rows by source
        parts = materialize(waiting.groupBy("src").agg(F.ceil(F.count("*") / BLOCK).alias("parts")), "parts")
        block = F.pmod(F.xxhash64(F.lit(seed + level), "key"), F.col("parts"))
        # dealt by block: a source alone may hold a third of the rows
        dealt = waiting.join(parts, "src").withColumn("block", block).repartition("src", "block")
        done = materialize(_round_blocks(dealt, level, seed), "rounded")
        open_ = (F.col("p") > EPSILON) & (F.col("p") < 1 - EPSILON)
        settled.append(done.where(~open_).select("unit", (F.col("p") > 0.5).alias("one")))
        waiting, level = done.where(open_), level + 1
        if not (waiting.groupBy("src").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0) > 1:
            break
    chance = F.expr(_uniform(f"{seed}L", "-1L", "key"))
    out = waiting.select("unit", (chance < F.col("p")).alias("one"))
    for part in settled:
        out = out.union(part)
    return out


def mix(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), cap: float = 3.0, seed: int = 11) -> DataFrame:
    """(doc_id, source, size, times, source_size, target, copies): a row for each distinct doc_id, source and size.

    ``times`` counts the rows that repeat it; each of them is taken ``copies``
    times.  A source's documents are rounded in the size classes of
    :data:`CLASSES`, largest first; what a class took more or less than expected
    changes the expectation of the smaller ones, so the last error is a small document.
    """
    units = materialize(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")).groupBy(
        "doc_id", "source", "size").agg(F.count("*").alias("times")), "units")
    targets = materialize(source_targets(units, weights, cap), "targets")
    relative = F.col("size") * F.col("docs") / F.greatest("source_size", F.lit(1))
    phase = sum((F.when(relative < limit, 1).otherwise(0) for limit in CLASSES), F.lit(0))
    full = materialize(units.join(targets, units["source"].eqNullSafe(targets["source"])).drop(targets["source"]).withColumn(
        "phase", phase), "classes")
    words = F.col("size") * F.col("times")
    sums = full.groupBy("src").agg(F.max("target").cast("double").alias("rest"), *[
        F.sum(F.when(F.col("phase") >= k, words).otherwise(0)).alias(f"from{k}") for k in range(len(CLASSES) + 1)])
    state, results = materialize(sums, "shares"), []
    kept = ("doc_id", "source", "size", "times", "source_size", "target")
    for k in range(len(CLASSES) + 1):
        ratio = F.when(F.col(f"from{k}") > 0, F.greatest(F.lit(0.0), F.least(
            F.lit(float(cap)), F.col("rest") / F.col(f"from{k}")))).otherwise(0.0)
        whole = F.floor(F.col("ratio") + EPSILON)
        rows = full.where(F.col("phase") == k).join(state.select("src", ratio.alias("ratio")), "src").withColumn(
            "whole", whole).withColumn("p", F.greatest(F.col("ratio") - whole, F.lit(0.0)))
        some = (F.col("p") > EPSILON) & (F.col("size") > 0)
        open_ = rows.where(some).select("src", words.cast("double").alias("words"), F.xxhash64(
            F.lit(seed), "doc_id", "size").alias("key"), "p", F.struct("src", *kept, "whole").alias("unit"))
        chosen = round_fractions(open_, seed + 100 * k).select("unit.*", F.col("one").cast("long").alias("more"))
        done = chosen.union(rows.where(~some).select("src", *kept, "whole", F.lit(0).cast("long")))
        result = materialize(done.withColumn("copies", F.col("whole") + F.col("more")).drop("whole", "more"), "copies")
        results.append(result.drop("src"))
        took = result.groupBy("src").agg(F.sum(words * F.col("copies")).alias("took"))
        state = materialize(state.join(took, "src", "left").withColumn(
            "rest", F.col("rest") - F.coalesce("took", F.lit(0))).drop("took"), "shares")
    out = results[0]
    for part in results[1:]:
        out = out.union(part)
    return out


def take(docs: DataFrame, mixed: DataFrame) -> DataFrame:
    """The rows of ``docs``, each as often as ``mixed`` takes it."""
    id_, source, size, copies, words, copy = (fresh(docs, c) for c in ("_id", "_source", "_size", "_copies", "_words", "_copy"))
    taken = mixed.where("copies > 0").select(
        F.col("doc_id").alias(id_), F.col("source").alias(source), F.col("size").alias(size), F.col("copies").alias(copies))
    own = docs.withColumn(words, word_count(F.col("text")))
    same = own["doc_id"].eqNullSafe(taken[id_]) & own["source"].eqNullSafe(taken[source]) & (own[words] == taken[size])
    return own.join(taken, same).withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(copies)))).select(*docs.columns)


def op6_mixing(spark, sf_dir) -> DataFrame:
    """Words taken of every document when sources are mixed 5 : 2 : 1, repeating."""
    mixed = mix(read_table(spark, sf_dir, "documents"))
    again = F.explode(F.sequence(F.lit(1).cast("long"), F.col("times")))
    return mixed.withColumn("_", again).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))
