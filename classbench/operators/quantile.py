"""Exact quantiles without a single-task sort.

``percentile`` (exact) keeps every distinct value of a group in one buffer and
``percentile_approx`` is only approximate.  Here the exact order statistics
are found by narrowing: approximate cut points split the current value range
into buckets, one aggregate counts rows per bucket, and only the bucket that
holds a wanted rank is kept.  Once a range holds at most ``direct_rows`` rows
it is sorted with a bounded top-k.  A range holding a single value (a hot
value, e.g. a third of all rows) resolves at once, and a range that does not
shrink is split at its minimum, so the loop always ends.  Quantiles of groups
come from running sums of counts instead (:func:`grouped_quantiles`).
"""

from __future__ import annotations

import math
from functools import reduce
from operator import and_

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from classbench.operators.rank import ranges_for
from classbench.session import written


def _in_range(v: Column, lo, lo_incl: bool, hi, hi_incl: bool) -> Column:
    cond = v.isNotNull() & ~F.isnan(v)
    if lo is not None:
        cond = cond & ((v >= F.lit(lo)) if lo_incl else (v > F.lit(lo)))
    if hi is not None:
        cond = cond & ((v <= F.lit(hi)) if hi_incl else (v < F.lit(hi)))
    return cond


def select_ranks(values: DataFrame, col: str, ranks: list[int], n: int,
                 direct_rows: int = 1 << 18, bins: int = 1024) -> dict[int, float]:
    """Values at 1-based ``ranks`` in ascending order of ``col`` (nulls/NaN excluded)."""
    v = F.col(col)
    out: dict[int, float] = {}
    work = [(None, True, None, True, 0, sorted(set(ranks)), n)]
    while work:
        lo, lo_incl, hi, hi_incl, base, rks, m = work.pop()
        sub = values.where(_in_range(v, lo, lo_incl, hi, hi_incl)).select(v.alias("v"))
        if m <= direct_rows:
            # bounded top-k from whichever end is nearer to the wanted ranks
            low = [r for r in rks if r - base <= m - (r - base) + 1]
            high = [r for r in rks if r not in low]
            if low:
                rows = [x[0] for x in sub.orderBy("v").limit(max(low) - base).collect()]
                for r in low:
                    out[r] = rows[r - base - 1]
            if high:
                take = m - (min(high) - base) + 1
                rows = [x[0] for x in sub.orderBy(F.desc("v")).limit(take).collect()]
                for r in high:
                    out[r] = rows[m - (r - base)]
            continue
        probs = [i / bins for i in range(1, bins)]
        cuts = sub.agg(F.percentile_approx("v", probs, 10 * bins).alias("c")).first()["c"]
        splits = sorted(set(float(c) for c in cuts if c is not None))
        edges = [-math.inf] + splits + [math.inf]
        bucketed = Bucketizer(splits=edges, inputCol="v", outputCol="b").transform(sub)
        stats = (bucketed.groupBy("b")
                 .agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("mn"), F.max("v").alias("mx"))
                 .orderBy("b").collect())
        seen = base
        for row in stats:
            cnt, mn, mx = row["n"], row["mn"], row["mx"]
            inside = [r for r in rks if seen < r <= seen + cnt]
            if inside:
                if mn == mx:
                    for r in inside:
                        out[r] = mn
                elif cnt == m:
                    # no progress: peel off the minimum value, keep the rest
                    n_min = sub.where(v == F.lit(mn)).count()
                    at_min = [r for r in inside if r <= seen + n_min]
                    for r in at_min:
                        out[r] = mn
                    rest = [r for r in inside if r > seen + n_min]
                    if rest:
                        work.append((mn, False, mx, True, seen + n_min, rest, cnt - n_min))
                else:
                    # the bucket's rows are exactly the rows within [mn, mx]
                    work.append((mn, True, mx, True, seen, inside, cnt))
            seen += cnt
    return out


def exact_quantiles(df: DataFrame, col: str, probs: list[float], n: int | None = None,
                    **kw) -> list[float | None]:
    """Linear-interpolated quantiles (pandas ``quantile``, DuckDB ``quantile_cont``)."""
    v = F.col(col).cast("double")
    values = df.select(v.alias(col)).where(F.col(col).isNotNull() & ~F.isnan(F.col(col)))
    if n is None:
        n = values.count()
    if n == 0:
        return [None] * len(probs)
    need = set()
    for p in probs:
        pos = (n - 1) * p
        need.add(int(math.floor(pos)) + 1)
        need.add(int(math.ceil(pos)) + 1)
    got = select_ranks(values, col, sorted(need), n, **kw)
    out = []
    for p in probs:
        pos = (n - 1) * p
        lo_r, hi_r = int(math.floor(pos)) + 1, int(math.ceil(pos)) + 1
        a, b = got[lo_r], got[hi_r]
        out.append(a + (b - a) * (pos - math.floor(pos)))
    return out


def _positions(n: int, probs: list[float]) -> list[tuple[int, int, float]]:
    out = []
    for p in probs:
        pos = (n - 1) * p
        out.append((int(math.floor(pos)) + 1, int(math.ceil(pos)) + 1, pos - math.floor(pos)))
    return out


def exact_quantiles_many(df: DataFrame, cols: list[str], probs: list[float], n_max: int | None = None,
                         accuracy: int | None = None, direct_rows: int = 1 << 18, extra=(),
                         return_row: bool = False):
    """Exact linear-interpolated quantiles of several columns in three passes.

    ``percentile_approx`` guarantees a rank error of at most n / accuracy, so
    approximate values at q -/+ 2/accuracy bracket every wanted order
    statistic.  Pass 1 finds the brackets for all columns (and the counts),
    pass 2 counts rows below and inside each bracket, pass 3 sorts only the
    rows inside brackets (each at most ``direct_rows``) with a window per
    bracket.  A bracket holding one value (a hot value) resolves without a
    sort; a bracket that is still too large falls back to ``select_ranks``.
    ``accuracy`` defaults to what keeps brackets near ``direct_rows / 8`` rows
    for ``n_max`` rows (between 1e3 and 1e6).  ``extra`` aggregates ride along
    in pass 1 (``return_row`` returns that row too).
    """
    if accuracy is None:
        accuracy = 1000 if n_max is None else int(min(1e6, max(1000, math.ceil(8 * n_max / direct_rows))))
    delta = 2.0 / accuracy
    lo_p = [max(0.0, p - delta) for p in probs]
    hi_p = [min(1.0, p + delta) for p in probs]
    from pyspark.sql.types import DoubleType, FloatType

    def num(c):
        x = F.col(f"`{c}`").cast("double")
        if isinstance(df.schema[c].dataType, (DoubleType, FloatType)):
            return F.when(~F.isnan(x), x)  # NaN cannot occur in integer columns
        return x

    aggs = []
    for i, c in enumerate(cols):
        aggs += [F.count(num(c)).alias(f"n{i}"),
                 F.percentile_approx(num(c), lo_p + hi_p, accuracy).alias(f"b{i}")]
    first = df.agg(*aggs, *extra).first()
    k = len(probs)
    # one bracket per (column, probability); adjacent ranks share it
    brackets = []  # (col index, lo, hi, ranks)
    for i, c in enumerate(cols):
        n = first[f"n{i}"]
        if not n:
            continue
        b = first[f"b{i}"]
        for j, (r_lo, r_hi, _) in enumerate(_positions(n, probs)):
            brackets.append((i, b[j], b[k + j], sorted({r_lo, r_hi})))
    # pass 2: rows below and inside each bracket, all brackets in one aggregate
    aggs = []
    for t, (i, lo, hi, _) in enumerate(brackets):
        x = num(cols[i])
        aggs += [F.count_if(x < F.lit(lo)).alias(f"below{t}"),
                 F.count_if((x >= F.lit(lo)) & (x <= F.lit(hi))).alias(f"in{t}")]
    cnt = df.agg(*aggs).first() if aggs else None
    values: dict[tuple[int, int], float] = {}
    direct = []  # (bracket, col index, relative rank, lo, hi, absolute rank)
    for t, (i, lo, hi, ranks) in enumerate(brackets):
        below, inside = cnt[f"below{t}"], cnt[f"in{t}"]
        for r in ranks:
            if (i, r) in values:
                continue
            if not (below < r <= below + inside):  # guarantee not met: general narrowing
                values[(i, r)] = select_ranks(df.select(num(cols[i]).alias("v")), "v", [r],
                                              first[f"n{i}"])[r]
            elif lo == hi:
                values[(i, r)] = lo
            elif inside > direct_rows:
                sub = df.select(num(cols[i]).alias("v")).where(
                    (F.col("v") >= F.lit(lo)) & (F.col("v") <= F.lit(hi)))
                values[(i, r)] = select_ranks(sub, "v", [r - below], inside)[r - below]
            else:
                direct.append((t, i, r - below, lo, hi, r))
    if direct:
        # pass 3: one scan emits (bracket, value) pairs; a window per bracket ranks them
        used = {}
        for t, i, _, lo, hi, _ in direct:
            used[t] = (i, lo, hi)
        pairs = F.array(*[F.when((num(cols[i]) >= F.lit(lo)) & (num(cols[i]) <= F.lit(hi)),
                                 F.struct(F.lit(t).alias("t"), num(cols[i]).alias("v")))
                          for t, (i, lo, hi) in used.items()])
        anywhere = None
        for t, (i, lo, hi) in used.items():
            cond = (num(cols[i]) >= F.lit(lo)) & (num(cols[i]) <= F.lit(hi))
            anywhere = cond if anywhere is None else anywhere | cond
        want = F.array(*[F.struct(F.lit(t).alias("t"), F.lit(rel).alias("rn"))
                         for t, _, rel, _, _, _ in direct])
        got = (df.where(anywhere).select(F.explode(F.filter(pairs, lambda s: s.isNotNull())).alias("p"))
               .select("p.t", "p.v")
               .withColumn("rn", F.row_number().over(Window.partitionBy("t").orderBy("v")))
               .where(F.array_contains(want, F.struct(F.col("t"), F.col("rn").cast("int").alias("rn"))))
               .collect())
        by = {(row["t"], row["rn"]): row["v"] for row in got}
        for t, i, rel, _, _, r in direct:
            values[(i, r)] = by[(t, rel)]
    out = {}
    for i, c in enumerate(cols):
        n = first[f"n{i}"]
        if not n:
            out[c] = [None] * k
            continue
        res = []
        for r_lo, r_hi, frac in _positions(n, probs):
            a, b = values[(i, r_lo)], values[(i, r_hi)]
            res.append(a + (b - a) * frac)
        out[c] = res
    return (out, first) if return_row else out


def grouped_quantiles(df: DataFrame, value: str, groups: list[str], probs: list[float],
                      rows_per_range: int = 1 << 20) -> DataFrame:
    """(groups..., n, q): exact linear-interpolated quantiles of every group, for any number and size of groups.

    Equal values of a group are counted before they are shuffled.  The
    (group, value) table is cut into ranges; sums per (group, range) say which
    ranges hold a wanted rank, and only in those are counts summed row by
    row.  ``n`` counts values other than null and NaN; a group without any has null quantiles.
    """
    v = F.col(value).cast("double")
    counts = written(df.groupBy(*groups, F.when(~F.isnan(v), v).alias("_v")).agg(F.count(F.lit(1)).alias("_c")), "values")
    ranges = ranges_for(counts, rows_per_range)
    dealt = counts.withColumn("_range", F.lit(0))
    if ranges > 1:
        order = [*groups, F.asc_nulls_last("_v")]
        dealt = written(counts.repartitionByRange(ranges, *order).withColumn("_range", F.spark_partition_id()), "ranges")
    sizes = counts.groupBy(*groups).agg(F.coalesce(F.sum(F.when(F.col("_v").isNotNull(), F.col("_c"))), F.lit(0)).alias("n"))
    known = dealt.where(F.col("_v").isNotNull())
    whole = Window.partitionBy(*groups)
    held = known.groupBy(*groups, "_range").agg(F.sum("_c").alias("_s")).select(
        *groups, "_range", "_s", (F.sum("_s").over(whole.orderBy("_range")) - F.col("_s")).alias("_off"),
        F.sum("_s").over(whole).alias("_n"))
    at = [F.lit(float(p)) * (F.col("_n") - 1) for p in probs]
    ranks = [r.cast("long") + 1 for h in at for r in (F.floor(h), F.ceil(h))]
    inside = F.exists(F.array(*ranks), lambda r: (r > F.col("_off")) & (r <= F.col("_off") + F.col("_s")))
    named = lambda t: t.select(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(groups)],
                               *[c for c in t.columns if c not in groups])
    same = lambda a, b: reduce(and_, [a[g].eqNullSafe(b[f"_g{i}"]) for i, g in enumerate(groups)])
    wanted = named(held.where(inside)).withColumnRenamed("_range", "_r")
    hit = known.join(wanted, same(known, wanted) & (known["_range"] == wanted["_r"]))
    upto = F.col("_off") + F.sum("_c").over(Window.partitionBy(*groups, "_range").orderBy("_v"))
    found = hit.withColumn("_upto", upto).groupBy(*groups, "_n").agg(*[
        F.max(F.when((F.col("_upto") - F.col("_c") < r) & (r <= F.col("_upto")), F.col("_v"))).alias(f"_q{i}")
        for i, r in enumerate(ranks)])
    low = lambda j: F.col(f"_q{2 * j}")
    q = F.array(*[low(j) + (F.col(f"_q{2 * j + 1}") - low(j)) * (h - F.floor(h)) for j, h in enumerate(at)])
    values = named(found.select(*groups, q.alias("q")))
    return sizes.join(values, same(sizes, values), "left").select(*groups, "n", "q")
